"""What a run moved: rows, shuffled and spilled bytes per node of the plan that ran."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame

from metrolens.plans.explain import JOIN_NODES

# Names of Spark's SQL metrics.
ROWS, WRITTEN, SPILLED = "numOutputRows", "shuffleBytesWritten", "spillSize"


@dataclass
class NodeRun:
    """One operator of an executed plan and what its metrics say; None where it has no such metric."""

    depth: int
    node: str
    rows: int | None
    shuffle_bytes: int | None
    spilled_bytes: int | None


def _children(plan) -> list:
    name = plan.nodeName()
    if name.startswith("AdaptiveSparkPlan"):
        return [plan.executedPlan()]
    if name.endswith("QueryStage"):
        return [plan.plan()]
    if name.startswith("ReusedExchange"):  # its rows are counted where they were made
        return []
    found = plan.children()
    return [found.apply(i) for i in range(found.size())]


def _walk(plan, depth: int) -> Iterator[NodeRun]:
    metrics = plan.metrics()

    def value(name: str) -> int | None:
        held = metrics.get(name)
        return int(held.get().value()) if held.isDefined() else None

    wrapper = plan.nodeName().startswith(("AdaptiveSparkPlan", "WholeStageCodegen", "InputAdapter")) or plan.nodeName().endswith("QueryStage")
    if not wrapper:
        yield NodeRun(depth, plan.nodeName().strip(), value(ROWS), value(WRITTEN), value(SPILLED))
    for child in _children(plan):
        yield from _walk(child, depth + (not wrapper))


def node_runs(df: DataFrame) -> list[NodeRun]:
    """The operators of ``df``'s executed plan, top first, after an action on ``df``
    itself (a ``collect``). Metrics are kept by the driver: nothing runs here."""
    return list(_walk(df._jdf.queryExecution().executedPlan(), 0))


@dataclass
class Moved:
    """Totals of a run: rows out of the scans and of every join, bytes written to shuffles and spilled."""

    read_rows: int
    join_rows: list[int]
    shuffle_bytes: int
    spilled_bytes: int


def moved(df: DataFrame) -> Moved:
    """Totals over :func:`node_runs`."""
    runs = node_runs(df)
    total = lambda values: sum(v for v in values if v is not None)
    return Moved(
        total(r.rows for r in runs if "Scan" in r.node),
        [r.rows or 0 for r in runs if r.node in JOIN_NODES],
        total(r.shuffle_bytes for r in runs),
        total(r.spilled_bytes for r in runs),
    )
