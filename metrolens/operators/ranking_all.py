"""Rank, dense rank and row number of every row, however large a group is.

A window sends a group to one task. Here the rows are sorted by (keys, order)
into ranges of even size, whatever group they belong to; every task numbers its
own range as it streams, and what a range needs to know about those before it
(rows of the group it continues, rank of the tie it continues) follows from the
last row of each range, one row per range.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metrolens.session import materialize

NUMBERS = ("__part", "__at", "__row", "__rank", "__dense", "__group", "__tie")


def _differs(col: pa.Array, before: pa.Scalar | None) -> np.ndarray:
    """Which values differ from the one before (NULLs are equal to each other, and so are NaNs)."""
    if before is None:
        behind = pa.concat_arrays([pa.nulls(1, col.type), col.slice(0, len(col) - 1)])
    else:
        behind = pa.concat_arrays([pa.array([before.as_py()], col.type), col.slice(0, len(col) - 1)])
    null, null_behind = (pc.is_null(c).to_numpy(zero_copy_only=False) for c in (col, behind))
    unequal = pc.fill_null(pc.not_equal(col, behind), False).to_numpy(zero_copy_only=False)
    if pa.types.is_floating(col.type):
        both = pc.and_(pc.is_nan(col), pc.is_nan(behind))
        unequal = unequal & ~pc.fill_null(both, False).to_numpy(zero_copy_only=False)
    out = unequal | (null != null_behind)
    if before is None:
        out[0] = True
    return out


def rank_all(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[tuple[str, str]],
    row_number: str = "row_number",
    rank: str = "rank",
    dense_rank: str = "dense_rank",
) -> DataFrame:
    """``df`` with the three numbers of each row within its group of ``keys``.

    ``order`` lists (column, ``ASC`` or ``DESC``), NULLs where Spark puts them.
    Rows equal in all of it share rank and dense rank, and their row numbers are
    dealt in any order (end with a unique column for a total one). NULL keys are
    one group. The sorted rows are written once under the shared checkpoint folder.
    """
    if any(way.upper() not in ("ASC", "DESC") for _, way in order):
        raise ValueError("every order is ASC or DESC")
    spark = df.sparkSession
    sorted_by = [name for name, _ in order]
    fields = [(n, T.IntegerType() if n == "__part" else T.LongType()) for n in NUMBERS]
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
    schema = T.StructType([*schema.fields, *[T.StructField(n, t, True) for n, t in fields]])
    key_names = list(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        last: dict[str, pa.Scalar] = {}
        # of the row before: place, row in group, rank, dense rank, group and tie numbers
        at = row = rank_no = dense = group = tie = -1
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            new = np.zeros(n, bool)
            for c in key_names:
                new |= _differs(batch.column(batch.schema.get_field_index(c)), last.get(c))
            if not last:
                new[0] = True
            new_tie = new.copy()
            for c in sorted_by:
                new_tie |= _differs(batch.column(batch.schema.get_field_index(c)), last.get(c))
            place = np.arange(n)
            # place where the current group and tie began, -1: before this batch
            began = np.maximum.accumulate(np.where(new, place, -1))
            tied = np.maximum.accumulate(np.where(new_tie, place, -1))
            rows = np.where(began >= 0, place - began + 1, row + 1 + place)
            ranks = np.where(tied >= 0, rows[np.maximum(tied, 0)], rank_no)
            steps = np.cumsum(new_tie)
            upto = np.where(began >= 0, steps[np.maximum(began, 0)] - 1, -dense)
            denses = steps - upto
            groups, ties = group + np.cumsum(new), tie + steps
            numbers = [np.full(n, part, np.int32), at + 1 + place, rows, ranks, denses, groups, ties]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(v.astype(np.int32 if i == 0 else np.int64)) for i, v in enumerate(numbers)]],
                names=schema.names,
            )
            at, row, rank_no, dense, group, tie = (int(v[-1]) for v in numbers[1:])
            last = {c: batch.column(batch.schema.get_field_index(c))[n - 1] for c in [*key_names, *sorted_by]}

    ways = [F.col(f"`{name}`").desc() if way.upper() == "DESC" else F.col(f"`{name}`").asc() for name, way in order]
    # Equal rows are dealt by their place in the input, so that a tie of any size spreads over ranges.
    ranged = df.orderBy(*[F.col(f"`{k}`") for k in keys], *ways, F.monotonically_increasing_id())
    done = materialize(ranged.mapInArrow(run, schema), "ranked")
    names = [F.col(f"`{c}`") for c in dict.fromkeys([*keys, *sorted_by])]
    first, final = F.struct(*names), F.struct(*names, *NUMBERS[2:])
    # One row per range.
    ends = done.groupBy("__part").agg(F.min_by(first, "__at").alias("first"), F.max_by(final, "__at").alias("last"))
    carried, before = [], None  # before: of the last row of the range before, (keys, order, row, rank, dense)
    for r in ends.orderBy("__part").collect():
        key, tie = ([_same(r["first"][c]) for c in some] for some in (keys, sorted_by))
        rows = ranks = denses = 0
        again = tied = False
        if before is not None and before[0] == key:
            again, tied = True, before[1] == tie
            rows, ranks = before[2], before[3]
            denses = before[4] - (1 if tied else 0)
        carried.append((r["__part"], rows, ranks, denses, again, tied))
        end = r["last"]
        in_first, in_tie = again and end["__group"] == 0, tied and end["__tie"] == 0
        before = (
            [_same(end[c]) for c in keys],
            [_same(end[c]) for c in sorted_by],
            end["__row"] + (rows if in_first else 0),
            ranks if in_tie else end["__rank"] + (rows if in_first else 0),
            end["__dense"] + (denses if in_first else 0),
        )
    offsets = spark.createDataFrame(
        carried, "__part int, __rows long, __ranks long, __denses long, __again boolean, __tied boolean"
    )
    own = F.col("__again") & (F.col("__group") == 0)
    placed = done.join(F.broadcast(offsets), "__part")
    return placed.select(
        *[F.col(f"`{c}`") for c in df.columns],
        (F.col("__row") + F.when(own, F.col("__rows")).otherwise(0)).alias(row_number),
        F.when(F.col("__tied") & (F.col("__tie") == 0), F.col("__ranks"))
        .otherwise(F.col("__rank") + F.when(own, F.col("__rows")).otherwise(0))
        .alias(rank),
        (F.col("__dense") + F.when(own, F.col("__denses")).otherwise(0)).alias(dense_rank),
    )


def _same(value):
    """A value that compares equal to itself, NaN included."""
    return "NaN" if isinstance(value, float) and value != value else value
