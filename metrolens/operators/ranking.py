"""Top-k rows per group through the DataFrame API and through SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metrolens.functions._util import as_col

TIE_RULES = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}


def topk_per_group(
    df: DataFrame,
    keys: Sequence[Column | str],
    order: Sequence[Column],
    k: int,
    ties: str = "rank",
    rank_name: str = "ranking",
) -> DataFrame:
    """Rows whose rank within their group is at most ``k``.

    ``ties="rank"`` keeps ties (more than k rows are possible), ``"dense_rank"``
    likewise without gaps, ``"row_number"`` returns at most k rows; give
    ``order`` a unique tie-break key so the choice is deterministic. A NULL
    group key forms its own group. Catalyst plans the rank filter as a
    ``WindowGroupLimit`` before the shuffle, so each map task forwards at
    most k rows (plus ties) per group, even for a very large group.
    """
    if ties not in TIE_RULES:
        raise ValueError(f"ties must be one of {tuple(TIE_RULES)}")
    if k < 1:
        raise ValueError("k must be at least 1")
    window = Window.partitionBy(*[as_col(c) for c in keys]).orderBy(*order)
    ranked = df.withColumn(rank_name, TIE_RULES[ties]().over(window))
    return ranked.filter(F.col(rank_name) <= k)


def quoted(name: str) -> str:
    """``name`` as a SQL identifier, whatever it holds."""
    return "`" + name.replace("`", "``") + "`"


def group_count_sql(spark: SparkSession, source: DataFrame | str, keys: Sequence[str], count_name: str) -> DataFrame:
    """Rows per combination of ``keys``, by SQL over a DataFrame or a view's name."""
    src = spark.table(source) if isinstance(source, str) else source
    listed = ", ".join(map(quoted, keys))
    return spark.sql(f"SELECT {listed}, COUNT(*) AS {quoted(count_name)} FROM {{src}} GROUP BY {listed}", src=src)


def topk_sql(
    spark: SparkSession,
    source: DataFrame | str,
    keys: Sequence[str],
    order: Sequence[tuple[str, str]],
    k: int,
    ties: str = "rank",
    rank_name: str = "ranking",
) -> DataFrame:
    """:func:`topk_per_group` as a SQL statement over a DataFrame or a view's name.

    ``order`` lists (column, ``ASC`` or ``DESC``); every name is quoted, so names
    with spaces work.
    """
    if ties not in TIE_RULES:
        raise ValueError(f"ties must be one of {tuple(TIE_RULES)}")
    if k < 1 or any(way.upper() not in ("ASC", "DESC") for _, way in order):
        raise ValueError("k is at least 1 and every order is ASC or DESC")
    src = spark.table(source) if isinstance(source, str) else source
    window = f"PARTITION BY {', '.join(map(quoted, keys))} ORDER BY " if keys else "ORDER BY "
    window += ", ".join(f"{quoted(column)} {way.upper()}" for column, way in order)
    statement = (
        f"WITH numbered AS (SELECT *, {ties.upper()}() OVER ({window}) AS {quoted(rank_name)} FROM {{src}}) "
        f"SELECT * FROM numbered WHERE {quoted(rank_name)} <= {int(k)}"
    )
    return spark.sql(statement, src=src)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Register ``df`` as a session temp view (for callers that write SQL by hand)."""
    df.createOrReplaceTempView(name)
    return df
