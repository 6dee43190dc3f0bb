"""Measured comparisons: join strategies, file formats, API forms, conversions.

Each report runs real jobs, so it is eager. A run is one aggregate over the
query's result (row count and a checksum over all columns), so any result size
works and nothing but that row reaches the driver. Every variant has a warm-up
run and then at least three timed runs, in rotated order so that none always
goes first; the median counts. The join operators are those of the plan that
ran (AQE's final plan). Reports give the fastest variant and how many times its
seconds each took, whether each returned the same rows as the first, and what
its last run moved: rows read, rows out of its joins, bytes shuffled and spilled.
"""

from __future__ import annotations

import statistics
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metrolens.plans.explain import executed_join_nodes
from metrolens.plans.metrics import Moved, moved

REPEATS = 3

REPORT_SCHEMA = (
    "{label} string, join_node string, rows bigint, same boolean, seconds double, relative double, fastest boolean, "
    "read_rows bigint, join_rows bigint, shuffle_bytes bigint, spilled_bytes bigint"
)


@dataclass
class Measured:
    """What the runs of one variant gave."""

    rows: int = 0
    checksum: int = 0
    joins: list[str] = field(default_factory=list)
    seconds: list[float] = field(default_factory=list)
    moved: Moved | None = None


def run_once(build: Callable[[], DataFrame]) -> tuple[int, int, list[str], float, Moved]:
    """Build and run a query: rows, order-free checksum, join operators, seconds, what it moved."""
    start = time.perf_counter()
    df = build()
    digest = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    # Two halves of the hash, so that the sums stay within a long at any size that ever runs.
    low, high = digest.bitwiseAND(F.lit((1 << 31) - 1)), F.shiftrightunsigned(digest, 33)
    summed = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(low).alias("low"), F.sum(high).alias("high"))
    (row,) = summed.collect()  # of this very plan, so that it can be read afterwards
    seconds = time.perf_counter() - start
    return row["rows"], hash((row["low"], row["high"])), executed_join_nodes(summed), seconds, moved(summed)


def measure(variants: dict[str, Callable[[], DataFrame]], repeats: int = REPEATS, warmup: bool = True) -> dict[str, Measured]:
    """Run every variant ``repeats`` times, in an order that rotates each round."""
    out = {name: Measured() for name in variants}
    names = list(variants)
    if warmup:
        for name in names:
            run_once(variants[name])
    for turn in range(max(1, repeats)):
        shift = turn % len(names)
        for name in names[shift:] + names[:shift]:
            rows, checksum, joins, seconds, what = run_once(variants[name])
            held = out[name]
            held.rows, held.checksum, held.joins, held.moved = rows, checksum, list(dict.fromkeys(joins)), what
            held.seconds.append(seconds)
    return out


def variant_report(
    spark: SparkSession,
    label: str,
    variants: dict[str, Callable[[], DataFrame]],
    repeats: int = REPEATS,
    warmup: bool = True,
) -> DataFrame:
    """A row per named query builder: see :data:`REPORT_SCHEMA` for the columns."""
    found = measure(variants, repeats, warmup)
    medians = {name: statistics.median(m.seconds) for name, m in found.items()}
    best = min(medians, key=medians.get)
    first = next(iter(found.values()))
    out = [
        (
            name,
            ",".join(m.joins) or None,
            m.rows,
            (m.rows, m.checksum) == (first.rows, first.checksum),
            medians[name],
            medians[name] / medians[best],
            name == best,
            m.moved.read_rows,
            sum(m.moved.join_rows) if m.joins else None,
            m.moved.shuffle_bytes,
            m.moved.spilled_bytes,
        )
        for name, m in found.items()
    ]
    return spark.createDataFrame(out, REPORT_SCHEMA.format(label=label))


def strategy_report(
    spark: SparkSession,
    build: Callable[[str], DataFrame],
    strategies: Sequence[str],
    repeats: int = REPEATS,
    warmup: bool = True,
    cache: Sequence[DataFrame] = (),
) -> DataFrame:
    """The same query under each join strategy.

    DataFrames in ``cache`` (the join inputs) are persisted and counted before
    timing, so every strategy starts from the same cached inputs, and
    unpersisted afterwards.
    """
    for df in cache:
        df.persist(StorageLevel.MEMORY_AND_DISK)
        df.count()
    try:
        return variant_report(spark, "strategy", {s: lambda s=s: build(s) for s in strategies}, repeats, warmup)
    finally:
        for df in cache:
            df.unpersist()


def format_report(spark: SparkSession, variants: dict[str, Callable[[], DataFrame]], repeats: int = REPEATS) -> DataFrame:
    """The same query over different source formats (each builder includes its read)."""
    return variant_report(spark, "format", variants, repeats)


def api_report(
    spark: SparkSession, queries: dict[str, dict[str, Callable[[], DataFrame]]], repeats: int = REPEATS
) -> DataFrame:
    """Each query in its API forms: the columns of :func:`variant_report` after ``query``."""
    reports = [
        variant_report(spark, "api", forms, repeats).select(F.lit(query).alias("query"), "*")
        for query, forms in queries.items()
    ]
    out = reports[0]
    for report in reports[1:]:
        out = out.unionByName(report)
    return out


def conversion_report(spark: SparkSession, convert: Callable[[], DataFrame], repeats: int = 1) -> DataFrame:
    """Time a conversion job (write included): DataFrame(job, rows, columns, seconds).

    ``convert`` writes its output and returns the lazy read of it; rows are
    counted by an aggregate, so no data reaches the driver.
    """
    runs = []
    for _ in range(max(1, repeats)):
        start = time.perf_counter()
        out = convert()
        rows = out.count()
        runs.append((time.perf_counter() - start, rows, len(out.columns)))
    seconds = statistics.median(r[0] for r in runs)
    return spark.createDataFrame(
        [("csv_to_parquet", runs[-1][1], runs[-1][2], float(seconds))],
        "job string, rows bigint, columns int, seconds double",
    )
