"""Equi-joins with a chosen physical strategy, and key-wise ratios of two aggregates."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

class BroadcastRefused(UserWarning):
    """A requested broadcast was too large and the planner chose the join instead."""


# Strategies a caller may ask for. "DEFAULT" leaves the choice to Catalyst/AQE
# (which broadcasts only below spark.sql.autoBroadcastJoinThreshold).
JOIN_STRATEGIES = ("DEFAULT", "broadcast", "merge", "shuffle_hash")

# Not offered: the hint plans a CartesianProduct (every pair of rows) even for
# an equi-join, which does not survive large inputs.
REJECTED_STRATEGIES = {"shuffle_replicate_nl": "plans a CartesianProduct of both sides"}

# Upper bounds for a forced broadcast.
MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 512 * 1024 * 1024


def check_strategy(strategy: str) -> None:
    """Raise unless ``strategy`` is one that is offered."""
    if strategy in REJECTED_STRATEGIES:
        raise ValueError(f"strategy {strategy!r} is not supported: {REJECTED_STRATEGIES[strategy]}")
    if strategy not in JOIN_STRATEGIES:
        raise ValueError(f"strategy must be one of {JOIN_STRATEGIES}")


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row's values: strings and binaries by length, nested values as JSON, others 16."""
    total = F.lit(0)
    for name, kind in df.dtypes:
        value = df[f"`{name}`"]
        if kind in ("string", "binary"):
            size = F.octet_length(value)
        elif kind.startswith(("array", "map", "struct")):
            size = F.octet_length(F.to_json(F.struct(value)))
        else:
            size = F.lit(16)
        total = total + F.coalesce(size, F.lit(0))
    return total.cast("bigint")


def fits_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows of at most ``max_bytes``
    in all: one aggregate over all its partitions."""
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(df)).alias("bytes")).first()
    return row["rows"] <= max_rows and (row["bytes"] or 0) <= max_bytes


def with_strategy(
    right: DataFrame,
    strategy: str,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``right`` carrying the join hint for ``strategy``.

    A broadcast is applied only after checking that ``right`` has at most
    ``max_broadcast_rows`` rows and ``max_broadcast_bytes`` of data. Beyond
    that the hint is refused with a :class:`BroadcastRefused` warning and the
    planner's default is used.
    """
    check_strategy(strategy)
    if strategy == "DEFAULT":
        return right
    if strategy == "broadcast" and not fits_broadcast(right, max_broadcast_rows, max_broadcast_bytes):
        warnings.warn(
            f"no broadcast: the side has more than {max_broadcast_rows} rows or {max_broadcast_bytes} bytes",
            BroadcastRefused,
            stacklevel=2,
        )
        return right
    return right.hint(strategy)


def hinted_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str] | Column,
    how: str = "inner",
    strategy: str = "DEFAULT",
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Join with the hint for ``strategy`` on the right side. NULL keys never match."""
    return left.join(with_strategy(right, strategy, max_broadcast_rows, max_broadcast_bytes), on=on, how=how)


def ratio_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    numerator: str,
    denominator: str,
    name: str,
    decimals: int | None = 2,
    strategy: str = "DEFAULT",
) -> DataFrame:
    """Inner-join two per-key tables and add ``numerator / denominator``.

    Division is ``try_divide`` (x/0 -> NULL, as ANSI mode would otherwise
    fail the job); the ratio is rounded HALF_UP to ``decimals`` unless None.
    """
    joined = hinted_join(left, right, key, "inner", strategy)
    ratio = F.try_divide(F.col(numerator).cast("double"), F.col(denominator).cast("double"))
    if decimals is not None:
        ratio = F.round(ratio, decimals)
    return joined.withColumn(name, ratio)
