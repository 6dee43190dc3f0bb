"""Reading physical plans."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

JOIN_NODES = (
    "BroadcastHashJoin",
    "SortMergeJoin",
    "ShuffledHashJoin",
    "BroadcastNestedLoopJoin",
    "CartesianProduct",
)


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def final_plan(df: DataFrame) -> str:
    """The physical plan that ran. After an action on ``df`` itself, AQE's
    plan is final (``isFinalPlan=true``); before it, the initial plan is
    returned, which AQE may still change."""
    text = plan_text(df, "simple")
    match = re.search(r"== Final Plan ==(.*?)(?:\+- == Initial Plan ==|\Z)", text, re.S)
    return match.group(1) if match else text


def executed_join_nodes(df: DataFrame) -> list[str]:
    """Join operators in the final plan, in plan order (e.g. ['BroadcastHashJoin'])."""
    text = final_plan(df)
    return re.findall(r"\b(" + "|".join(JOIN_NODES) + r")\b", text)
