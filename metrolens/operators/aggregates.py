"""Grouped counts, sums, means and conditional shares.

All are single ``groupBy().agg()`` calls: Spark plans a partial
(map-side) aggregate before the shuffle, so a hot key that holds a third of
all rows is collapsed to one row per map task before it moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metrolens.functions._util import as_col
from metrolens.functions.buckets import NULL_POLICIES


def global_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    """Row count as a one-row DataFrame (lazy, unlike ``df.count()``)."""
    return df.agg(F.count(F.lit(1)).alias(name))


def group_count(df: DataFrame, keys: Sequence[Column | str], name: str = "count") -> DataFrame:
    return df.groupBy(*[as_col(k) for k in keys]).agg(F.count(F.lit(1)).alias(name))


def conditional_count(
    df: DataFrame,
    keys: Sequence[Column | str],
    predicate: Column,
    name: str = "matching",
    total_name: str | None = None,
) -> DataFrame:
    """Rows per group for which ``predicate`` is true (NULL counts as false)."""
    aggs = [F.count_if(F.coalesce(predicate, F.lit(False))).alias(name)]
    if total_name:
        aggs.append(F.count(F.lit(1)).alias(total_name))
    return df.groupBy(*[as_col(k) for k in keys]).agg(*aggs)


def group_sum(df: DataFrame, keys: Sequence[Column | str], value: Column | str, name: str = "total") -> DataFrame:
    return df.groupBy(*[as_col(k) for k in keys]).agg(F.sum(as_col(value)).alias(name))


def group_avg(
    df: DataFrame,
    keys: Sequence[Column | str],
    values: dict[str, Column | str],
    decimals: int | None = 3,
    count_name: str | None = None,
) -> DataFrame:
    """Mean of each ``{name: column}`` per group, rounded HALF_UP to ``decimals``."""
    aggs = []
    for name, value in values.items():
        mean = F.avg(as_col(value))
        aggs.append((F.round(mean, decimals) if decimals is not None else mean).alias(name))
    if count_name:
        aggs.append(F.count(F.lit(1)).alias(count_name))
    return df.groupBy(*[as_col(k) for k in keys]).agg(*aggs)


def share_by(
    df: DataFrame,
    key: Column,
    predicate: Column,
    key_name: str,
    pct_name: str = "pct",
    null_policy: str = "default",
    decimals: int = 2,
    keep_counts: bool = False,
) -> DataFrame:
    """Percentage of rows per group for which ``predicate`` holds.

    ``key`` is usually a :func:`metrolens.functions.bucket` column; with
    ``null_policy="drop"`` rows whose key is NULL are filtered before grouping
    (the reference's RDD form), otherwise a NULL key is its own group.
    ``pct = round(matching / total * 100, decimals)`` with ``try_divide``.
    """
    if null_policy not in NULL_POLICIES:
        raise ValueError(f"null_policy must be one of {NULL_POLICIES}")
    keyed = df.select(key.alias(key_name), F.coalesce(predicate, F.lit(False)).alias("__match"))
    if null_policy == "drop":
        keyed = keyed.filter(F.col(key_name).isNotNull())
    grouped = keyed.groupBy(key_name).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("__match")).alias("matching")
    )
    pct = F.round(F.try_divide(F.col("matching"), F.col("total")) * F.lit(100.0), decimals).alias(pct_name)
    cols = [F.col(key_name), pct] + ([F.col("total"), F.col("matching")] if keep_counts else [])
    return grouped.select(*cols)
