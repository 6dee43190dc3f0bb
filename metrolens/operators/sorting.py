"""Global order made explicit: position columns and first-n rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metrolens.session import materialize

_ROW_BITS = 33  # monotonically_increasing_id keeps the row index in the low 33 bits


def with_position(df: DataFrame, order: Sequence[Column], name: str = "pos") -> DataFrame:
    """Add the 1-based position of each row in the total order ``order``.

    No single-partition window: the data is range-partitioned and sorted by
    ``orderBy``, each row gets (partition, index-in-partition) from
    ``monotonically_increasing_id``, per-partition counts (one row per
    partition) become offsets, and a broadcast join of that tiny table adds
    them. The sorted, tagged data is written once under the shared checkpoint
    folder first, so both uses read the same row tags. ``order`` should
    be total (end with a unique key) for positions to be deterministic.
    """
    tagged = materialize(df.orderBy(*order).withColumn("__mid", F.monotonically_increasing_id()), "position")
    tagged = tagged.withColumn("__part", F.shiftright(F.col("__mid"), _ROW_BITS))
    counts = tagged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of ``tagged``: bounded by its partition count.
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    local = F.col("__mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        tagged.join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__offset") + local + F.lit(1))
        .drop("__mid", "__part", "__offset")
    )


def limit_n(df: DataFrame, order: Sequence[Column], n: int, name: str | None = "pos") -> DataFrame:
    """First ``n`` rows in ``order`` (planned as ``TakeOrderedAndProject``:
    each task keeps its own top n, only n rows per task move). With ``name``,
    a 1-based position over those n rows is added."""
    head = df.orderBy(*order).limit(n)
    if not name:
        return head
    return head.withColumn(name, F.row_number().over(Window.orderBy(*order)))
