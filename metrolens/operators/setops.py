"""Union, difference and result comparison."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(dfs: Sequence[DataFrame], by_position: bool = False) -> DataFrame:
    """UNION ALL. By name by default (schemas must agree on names); ``by_position``
    reproduces ``DataFrame.union``, which pairs columns by order only."""
    if not dfs:
        raise ValueError("need at least one DataFrame")
    if by_position:
        return reduce(lambda a, b: a.union(b), dfs)
    return reduce(lambda a, b: a.unionByName(b), dfs)


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` not in ``right`` (NULLs compare equal), columns by position.

    One shuffle: both sides are folded by all columns in the map tasks, each row
    with whether the right side has it, so a row that holds a third of the data
    leaves each task once.
    """
    cols = left.columns
    if len(cols) != len(right.columns):
        raise ValueError("left and right need the same number of columns")
    names = [f"c{i}" for i in range(len(cols))]
    tagged = left.toDF(*names).withColumn("in_right", F.lit(False)).unionAll(
        right.toDF(*names).withColumn("in_right", F.lit(True))
    )
    return tagged.groupBy(*names).agg(F.max("in_right").alias("hit")).filter(~F.col("hit")).select(*names).toDF(*cols)


def diff_tables(left: DataFrame, right: DataFrame, side_name: str = "side", copies_name: str = "copies") -> DataFrame:
    """Multiset difference in both directions in one shuffle.

    Each row of ``left`` counts +1 and each of ``right`` -1; grouping by all
    columns (NULL-safe) leaves the surplus: ``side`` is ``'left_only'`` or
    ``'right_only'`` and ``copies`` the surplus multiplicity. Empty result
    means equal multisets. Partial aggregation folds duplicates map-side.
    """
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError("left and right need the same column names")
    cols = left.columns
    tagged = left.select(*cols, F.lit(1).alias("__w")).unionByName(right.select(*cols, F.lit(-1).alias("__w")))
    surplus = tagged.groupBy(*cols).agg(F.sum("__w").alias("__d")).filter(F.col("__d") != 0)
    return surplus.select(
        F.when(F.col("__d") > 0, F.lit("left_only")).otherwise(F.lit("right_only")).alias(side_name),
        *cols,
        F.abs(F.col("__d")).cast("bigint").alias(copies_name),
    )


def same_rows(left: DataFrame, right: DataFrame) -> bool:
    """True when both sides hold the same rows with the same multiplicities (one job)."""
    return diff_tables(left, right).isEmpty()


def bucket_sums(df: DataFrame, columns: Sequence[str], buckets: int) -> DataFrame:
    """``(__bucket, rows, low, high, mixed)``: per hash bucket, row count and sums
    that do not depend on the order of rows. At most ``buckets`` rows leave a task."""
    one = F.xxhash64(*[F.col(f"`{c}`") for c in columns])
    other = F.xxhash64(F.lit("second"), *[F.col(f"`{c}`") for c in reversed(columns)])
    hashed = df.select(one.alias("__one"), other.alias("__other"))
    return hashed.groupBy(F.pmod("__one", F.lit(buckets)).cast("int").alias("__bucket")).agg(
        F.count(F.lit(1)).alias("rows"),
        # halves of the hashes, so that the sums stay within a long
        F.sum(F.col("__one").bitwiseAND(F.lit((1 << 32) - 1))).alias("low"),
        F.sum(F.shiftrightunsigned("__one", 32)).alias("high"),
        F.sum(F.col("__other").bitwiseAND(F.lit((1 << 32) - 1))).alias("other_low"),
        F.sum(F.shiftrightunsigned("__other", 32)).alias("other_high"),
    )


def bucket_diff(
    left: DataFrame, right: DataFrame, side_name: str = "side", copies_name: str = "copies", buckets: int = 4096
) -> DataFrame:
    """:func:`diff_tables` for results that are large and mostly equal.

    Each side is folded to one row per hash bucket: its row count and sums of
    two 64-bit hashes. Buckets whose figures agree hold the same rows; only the
    rows of the others are compared, so equal inputs move bucket rows alone (a
    bucket that differs is taken for equal only if all five figures agree by
    chance). The inputs are read twice: materialize them if reading is dear.
    """
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError("left and right need the same column names")
    cols = left.columns
    right = right.select(*[F.col(f"`{c}`") for c in cols])
    figures = ["rows", "low", "high", "other_low", "other_high"]
    a = bucket_sums(left, cols, buckets)
    b = bucket_sums(right, cols, buckets).toDF("__of", *[f"r_{c}" for c in figures])
    agree = F.lit(True)
    for c in figures:
        agree = agree & F.col(c).eqNullSafe(F.col(f"r_{c}"))
    unequal = a.join(b, F.col("__bucket") == F.col("__of"), "full_outer").filter(~agree)
    unequal = unequal.select(F.coalesce("__bucket", "__of").alias("__unequal"))

    def descended(df: DataFrame) -> DataFrame:
        bucket = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in cols]), F.lit(buckets)).cast("int")
        # At most ``buckets`` rows.
        return df.withColumn("__bucket", bucket).join(
            F.broadcast(unequal), F.col("__bucket") == F.col("__unequal"), "left_semi"
        ).drop("__bucket")

    return diff_tables(descended(left), descended(right), side_name, copies_name)
