"""Small helpers shared by the pipeline operators."""

from __future__ import annotations

import ctypes
import functools
import sys
import types
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metrolens.session import materialize, materialize_observed, staging_path

__all__ = [
    "connected_components",
    "fresh",
    "lean",
    "materialize",
    "materialize_observed",
    "order_totals",
    "STEP",
    "scrambled",
    "slices",
    "sorted_runs",
    "span_hashes",
    "span_numbers",
    "stage",
    "table",
    "tasks_for",
    "unscrambled",
    "worker_cache",
    "with_fields",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; the path is read by Spark alone, so any store works."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` under the shared folder with the given codec and read it back."""
    path = staging_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def worker_cache(name: str, make: Callable[[], object]) -> object:
    """One object per Python worker process, kept between its tasks."""
    held = sys.modules.setdefault("_pipeline_worker_cache", types.ModuleType("_pipeline_worker_cache"))
    if not hasattr(held, name):
        setattr(held, name, make())
    return getattr(held, name)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``rows`` rows, without copying them: only
    as many texts become Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def lean(run: Callable) -> Callable:
    """``run`` over batches that hands its freed memory back when a task ends.

    Python workers outlive their tasks, and idle ones still count against an
    executor's memory.
    """

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim is not None:
            trim(0)

    return wrapped


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names built from ``names`` that ``df`` does not use, in any letter case.

    Operators add working columns; an input may already have one of that name.
    """
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        candidate = name
        while candidate.lower() in taken:
            candidate = f"{name}_{uuid.uuid4().hex[:6]}"
        taken.add(candidate.lower())
        out.append(candidate)
    return out


def with_fields(schema: T.StructType, fields: Sequence[tuple[str, T.DataType]]) -> T.StructType:
    """``schema`` followed by the given nullable fields."""
    return T.StructType(list(schema.fields) + [T.StructField(n, t, True) for n, t in fields])


def order_totals(df: DataFrame, order: Sequence[Column], value: str, rank: str, before: str) -> DataFrame:
    """Add the 0-based rank of each row in ``order`` and the sum of ``value``
    over the rows before it.

    One range sort deals the rows evenly whatever a key's share is (end
    ``order`` with a unique column). Each task numbers and sums its own sorted
    range as it streams, the result is written once, and the totals of the
    tasks (one row each) become offsets that are broadcast back.
    """
    spark = df.sparkSession
    part, n_col, s_col = fresh(df, "__part", "__n", "__s")
    schema = with_fields(df.schema, [(part, T.IntegerType()), (rank, T.LongType()), (before, T.LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        rows = total = 0
        for batch in batches:
            values = batch.column(batch.schema.get_field_index(value)).to_numpy(zero_copy_only=False).astype(np.int64)
            sums = np.cumsum(values)
            yield pa.RecordBatch.from_arrays(
                batch.columns
                + [
                    pa.array(np.full(len(values), pid, np.int32)),
                    pa.array(rows + np.arange(len(values), dtype=np.int64)),
                    pa.array(total + sums - values),
                ],
                names=batch.schema.names + [part, rank, before],
            )
            rows += len(values)
            total += int(sums[-1]) if len(values) else 0

    done = materialize(df.orderBy(*order).mapInArrow(lean(number), schema), "ordered")
    totals = done.groupBy(part).agg(F.count(F.lit(1)).alias(n_col), F.sum(value).alias(s_col))
    # One row per task of the sort: its size is the partition count.
    offsets = spark.createDataFrame(
        _running(totals.orderBy(part).collect()), f"{part} int, {n_col} long, {s_col} long"
    )
    return (
        done.join(F.broadcast(offsets), part)
        .withColumn(rank, F.col(rank) + F.col(n_col))
        .withColumn(before, F.col(before) + F.col(s_col))
        .drop(part, n_col, s_col)
    )


def _running(rows: list) -> list[tuple]:
    out, n, s = [], 0, 0
    for part, count, total in rows:
        out.append((part, n, s))
        n, s = n + count, s + total
    return out


STEP = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64


def byte_numbers() -> np.ndarray:
    """A random odd 64-bit number for each byte."""
    return np.random.default_rng(12).integers(0, 1 << 63, 256, dtype=np.uint64) * 2 + 1


def step_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of STEP and of its inverse; those of common lengths are kept by the worker."""

    def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.cumprod(np.full(n, base, np.uint64)) for base in (STEP, pow(STEP, -1, 1 << 64)))

    if n > 1 << 20:
        return powers(n)
    up, back = worker_cache("step-powers", lambda: powers(1 << 20))
    return up[:n], back[:n]


def scrambled(x: np.ndarray) -> np.ndarray:
    """64-bit numbers with all bits mixed."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def unscrambled(x: np.ndarray) -> np.ndarray:
    """The numbers that :func:`scrambled` has mixed: no two of them become the same."""
    for shift, factor in ((31, 0x94D049BB133111EB), (27, 0xBF58476D1CE4E5B9)):
        x = (x ^ (x >> np.uint64(shift)) ^ (x >> np.uint64(2 * shift))) * np.uint64(pow(factor, -1, 1 << 64))
    return x ^ (x >> np.uint64(30)) ^ (x >> np.uint64(60))


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0, block: int = 1 << 20) -> np.ndarray:
    """64-bit hashes of byte spans in order (``ends[i] <= starts[i + 1]``), ``block`` bytes at a time."""
    numbers = worker_cache("byte-numbers", byte_numbers)
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = starts[at]
        upto = max(at + 1, int(np.searchsorted(ends, low + block, side="right")))
        high = ends[upto - 1]
        up, back = step_powers(int(high - low))
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(numbers[raw[low:high]] * up, out=sums[1:])
        first, end = starts[at:upto] - low, ends[at:upto] - low
        out[at:upto] = scrambled((sums[end] - sums[first]) * back[np.minimum(first, len(back) - 1)] + np.uint64(seed))
        at = upto
    return out


def span_numbers(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(first, number)``: the first of each kind of span, and every span's kind.
    Spans of one kind are equal: spans of one hash are compared byte by byte."""
    _, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    size, like = ends - starts, first[number]
    if (size == size[like]).all():
        offset = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        if (raw[offset + np.repeat(starts, size)] == raw[offset + np.repeat(starts[like], size)]).all():
            return first, number
    spans = np.empty(len(starts), object)  # two spans share a hash
    spans[:] = [raw[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist())]
    _, first, number = np.unique(spans, return_index=True, return_inverse=True)
    return first, number


def sorted_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[dict[str, np.ndarray]]:
    """Groups of equal ``key`` out of batches sorted by it, as column arrays.

    Numeric columns without nulls only. Holds one group and one batch at a time.
    """
    held: list[dict[str, np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = {n: batch.column(i).to_numpy(zero_copy_only=False) for i, n in enumerate(batch.schema.names)}
        cuts = np.flatnonzero(np.diff(cols[key])) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            piece = {n: v[a:b] for n, v in cols.items()}
            if held and held[0][key][0] != piece[key][0]:
                yield _joined(held)
                held = []
            held.append(piece)
    if held:
        yield _joined(held)


def _joined(pieces: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    return pieces[0] if len(pieces) == 1 else {n: np.concatenate([p[n] for p in pieces]) for n in pieces[0]}


def tasks_for(rows: int, each: int = 500_000) -> int:
    """Tasks for so many narrow rows; no more than a job has anyway (``coalesce`` never adds any)."""
    return max(1, -(-rows // each))


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``(node, root)`` for every node of ``edges``; root is its component's smallest node.

    Alternating large-star and small-star steps, each a grouped minimum (folded
    in the map tasks) and an equality join, until the edge set is a set of
    stars that no longer changes. Every round is written to the shared folder,
    so no lineage grows and a lost executor costs one round's tasks.
    """
    a, b = F.col(u), F.col(v)
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    pairs, state = _star_state(pairs)
    while True:
        # A round's tables are about as large as the last one's edges.
        sized = lambda df, n=state[0]: df.coalesce(tasks_for(n))
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = sized(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        # pairs hold u > v, so the larger neighbours of a node are the u of the pairs where it is v
        large = sized(pairs.select(F.col("v").alias("u"), F.col("u").alias("w")).join(lowest, "u").select("w", "m")).distinct()
        large = large.select(F.col("w").alias("u"), F.col("m").alias("v")).filter("u <> v")
        large = materialize(sized(large), "large-star")
        lowest = sized(large.groupBy("u").agg(F.min("v").alias("m")))
        small = (
            sized(large.join(lowest, "u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v")
            .unionByName(lowest.select("u", F.col("m").alias("v")))
            .distinct()
        )
        pairs, now = _star_state(sized(small))
        if now == state:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        state = now


def _star_state(pairs: DataFrame) -> tuple[DataFrame, tuple]:
    """The written pairs and a summary that changes when their set does."""
    digest: Column = F.xxhash64("u", "v")
    done, seen = materialize_observed(
        pairs,
        "stars",
        {
            "n": F.count(F.lit(1)),
            "a": F.sum(digest.bitwiseAND(F.lit((1 << 31) - 1))),
            "b": F.sum(F.shiftrightunsigned(digest, 33)),
        },
    )
    return done, (seen["n"], seen["a"], seen["b"])
