"""Joins in which a few keys hold much of both sides.

A key that many rows of both sides share sends all of them to one task, and
adaptive execution can split only one side of it at a time. Here such keys are
found first and their rows are dealt on a grid: a left row goes to one line of
the grid and is copied along it, a right row to one column, so every pair meets
in exactly one cell and a cell is a small join of its own. All other keys have one
cell each.

Making pairs is nearly all of the work. They come out of one sort-merge join and
go on in the same generated loop: rows are put together before the join, pairs
never pass through a union, and no side is broadcast, whatever its size seemed to
be before its rows were copied.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metrolens.session import materialize

TRACKED = 1024  # keys that the summary of a side follows: a key with over 1/500 of the rows is never missed
CELLS = 4  # cells that the rows of a task would fill
PAIRS = 1 << 28  # pairs of one key that a task makes: a key of more is dealt to more cells


def _digest(keys: Sequence[str]):
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys])


def frequent_keys(df: DataFrame, keys: Sequence[str], tasks: int, tracked: int = TRACKED) -> tuple[dict[int, int], int]:
    """Hashes of the most frequent keys with their number of rows as the summary
    puts it, and the number of all rows.

    One aggregate with a mergeable frequent-items summary: a fixed number of
    counters per task, merged into one row.
    """
    given = " AND ".join(f"`{k}` IS NOT NULL" for k in keys)
    summary = F.expr(f"approx_top_k(digest, {min(tracked, 4 * tasks)}, {tracked})")
    rows = df.filter(given).select(_digest(keys).alias("digest"))
    row = rows.agg(summary.alias("top"), F.count(F.lit(1)).alias("n")).first()
    return {t["item"]: t["count"] for t in row["top"] or []}, row["n"]


def heavy_keys(df: DataFrame, keys: Sequence[str], tasks: int, tracked: int = TRACKED) -> tuple[dict[int, int], int]:
    """Of :func:`frequent_keys`, those with at least a task's mean share of the rows."""
    found, n = frequent_keys(df, keys, tasks, tracked)
    return {key: count for key, count in found.items() if count * tasks >= n}, n


def grid_of(left: int, right: int, target: int, pairs: int) -> tuple[int, int]:
    """Lines and columns for a key's ``left`` and ``right`` rows: at most about
    ``target`` rows of a side and ``pairs`` pairs in a cell, with few copies."""
    lines, columns = max(1, -(-left // target)), max(1, -(-right // target))
    cells = -(-left * right // pairs)
    if cells > lines * columns:
        # Rows are copied least where a cell is about square.
        lines = max(lines, min(cells, round((cells * left / right) ** 0.5)))
        columns = max(columns, -(-cells // lines))
    return lines, columns


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    tasks: int | None = None,
    pairs: int = PAIRS,
) -> DataFrame:
    """Equi-join of ``left`` and ``right`` on the columns ``keys`` (``how`` is inner or left).

    A key is dealt on a grid if it holds at least a task's mean share of either
    side, or makes more than ``pairs`` pairs; there are as many cells as its rows
    and its pairs ask for, so no task grows with them. Its rows are numbered and written once, so a lost executor deals them
    the same way again; equal rows spread like any others. NULL keys never match.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    spark = left.sparkSession
    tasks = tasks or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    (of_left, n_left), (of_right, n_right) = frequent_keys(left, keys, tasks), frequent_keys(right, keys, tasks)
    large = {k for of, n in ((of_left, n_left), (of_right, n_right)) for k, count in of.items() if count * tasks >= n}
    heavy = sorted(large | {k for k in of_left if of_left[k] * of_right.get(k, 0) > pairs})
    if not heavy:
        return left.join(right, list(keys), how)

    target = max(1, (n_left + n_right) // (CELLS * tasks))
    grids = []  # a bounded list: the summaries follow a fixed number of keys
    for key in heavy:
        grids.append((key, *grid_of(of_left.get(key, 0), of_right.get(key, 0), target, pairs)))
    grid = spark.createDataFrame(grids, "digest long, lines long, columns long")

    def parted(df: DataFrame) -> tuple[DataFrame, DataFrame]:
        # A row with a NULL key has no digest: it is light.
        nameless = " OR ".join(f"`{k}` IS NULL" for k in keys)
        tagged = df.withColumn("__digest", F.when(~F.expr(nameless), _digest(keys)))
        few = F.col("__digest").isin(heavy)
        return tagged.filter(~F.coalesce(few, F.lit(False))).drop("__digest"), tagged.filter(few)

    light_left, heavy_left = parted(left)
    light_right, heavy_right = parted(right)

    def dealt(df: DataFrame, own: str, other: str, name: str) -> DataFrame:
        numbered = materialize(df.withColumn("__row", F.monotonically_increasing_id()), name)
        placed = numbered.join(F.broadcast(grid), F.col("__digest") == F.col("digest"))
        mine = F.pmod(F.xxhash64("__row"), F.col(own)).alias(f"__{own}")
        along = F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias(f"__{other}")
        return placed.select(*[F.col(f"`{c}`") for c in df.columns if c != "__digest"], mine, along)

    a, b = dealt(heavy_left, "lines", "columns", "skew-left"), dealt(heavy_right, "columns", "lines", "skew-right")
    if how == "inner":
        # Light keys have a cell of their own, outside of every grid.
        own = {c: F.lit(-1).cast("long") for c in ("__lines", "__columns")}
        a, b = a.unionByName(light_left.withColumns(own)), b.unionByName(light_right.withColumns(own))
    many = sum(lines * columns for _, lines, columns in grids)
    if many > tasks or sum(count * of_right.get(k, 0) for k, count in of_left.items()) > pairs:
        # A stated number of tasks: adaptive execution, which sees few bytes, does not fold cells of many pairs together.
        on = [*[F.col(f"`{k}`") for k in keys], "__lines", "__columns"]
        a, b = a.repartition(tasks + many, *on), b.repartition(tasks + many, *on)
    cells = a.join(b.hint("merge"), [*keys, "__lines", "__columns"]).drop("__lines", "__columns")
    if how == "inner":
        return cells
    out = light_left.join(light_right, list(keys), how).unionByName(cells)
    # Heavy keys that the right side lacks; one row a key is enough to tell.
    known = heavy_right.select(*keys).distinct()
    bare = heavy_left.drop("__digest").join(known, list(keys), "left_anti")
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema if f.name not in keys]
    return out.unionByName(bare.select("*", *missing))
