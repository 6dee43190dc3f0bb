"""Parquet tables clustered for range filters on several columns, in files of even size.

Rows are sorted along a curve through the ranks of the chosen columns, so a file
covers a small range of each of them; the number of files follows from the
bytes a row takes, measured on a written sample. The table is written beside its
place and published by one rename, with an index in it: a small table with the
ranges of every file, found by one aggregate over the written files. Readers
filter the index and leave out the files that cannot hold a wanted row.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Sequence
from datetime import date, datetime, timezone
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metrolens.session import staging_path

RANK_BITS = 6  # ranks of a column: 64 of about equal size
SAMPLE_ROWS = 100_000  # about so many rows are written to measure their size
INDEX = "_ranges/files"  # place of a table's index; Spark reads no folder of such a name with the table


def _number(df: DataFrame, name: str) -> Column:
    """A column as a double that keeps its order."""
    kind, value = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    if isinstance(kind, T.NumericType):
        return value.cast("double")
    raise ValueError(f"column {name} is neither a number nor a date")


def curve_key(df: DataFrame, columns: Sequence[str]) -> Column:
    """Place of a row on a curve through the ranks of its ``columns`` (NULL ranks
    first): the bits of the ranks taken in turn. One aggregate finds the ranks' edges."""
    if not 1 <= len(columns) <= 62 // RANK_BITS:
        raise ValueError(f"between 1 and {62 // RANK_BITS} columns are expected")
    count = 1 << RANK_BITS
    shares = F.array(*[F.lit(i / count) for i in range(1, count)])
    edges = df.agg(*[F.percentile_approx(_number(df, c), shares, 1000).alias(f"e{i}") for i, c in enumerate(columns)]).first()
    key = F.lit(0).cast("long")
    for i, c in enumerate(columns):
        steps = F.array(*[F.lit(e) for e in sorted(set(edges[i] or []))]).cast("array<double>")
        own = _number(df, c)
        rank = F.size(F.filter(steps, lambda e: e < own)).cast("long")  # noqa: B023
        for bit in range(RANK_BITS):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("long"))
            key = key.bitwiseOR(F.shiftleft(one, bit * len(columns) + i))
    return key


def _hadoop(spark: SparkSession, path: str):
    """``(file system, path)`` of a path, as Spark itself sees it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _bytes(spark: SparkSession, path: str) -> int:
    fs, at = _hadoop(spark, path)
    return fs.getContentSummary(at).getLength()


def bytes_per_row(df: DataFrame, rows: int) -> float:
    """Parquet bytes a row takes, measured on a written sample of about ``SAMPLE_ROWS``."""
    path = staging_path(df.sparkSession, "row-size")
    share = min(1.0, SAMPLE_ROWS / max(1, rows))
    df.sample(fraction=share, seed=1).repartition(1).write.parquet(path)
    seen = df.sparkSession.read.parquet(path).count()
    return _bytes(df.sparkSession, path) / seen if seen else 1.0


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], file_bytes: int = 256 << 20) -> str:
    """Write ``df`` to ``path`` in files of about ``file_bytes``, each covering
    small ranges of the numeric or date ``columns``. The table is there whole or
    not at all; one that stands there already is replaced."""
    spark = df.sparkSession
    rows = df.count()
    files = max(1, -(-int(rows * bytes_per_row(df, rows)) // file_bytes))
    key = f"__key_{uuid.uuid4().hex[:6]}"
    keyed = df.withColumn(key, curve_key(df, columns))
    # Rows of one key may be many: they are dealt by their own values too.
    spread = [F.col(key), *[F.col(f"`{c}`") for c in columns], F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]
    made = f"{path.rstrip('/')}.making-{uuid.uuid4().hex[:8]}"
    keyed.repartitionByRange(files, *spread).sortWithinPartitions(*spread[:-1]).drop(key).write.parquet(made)
    _measured(spark.read.schema(df.schema).parquet(made)).write.parquet(f"{made}/{INDEX}")
    fs, new = _hadoop(spark, made)
    _, place = _hadoop(spark, path)
    old = None
    if fs.exists(place):
        _, old = _hadoop(spark, f"{made}.old")
        fs.rename(place, old)
    if not fs.rename(new, place):
        raise OSError(f"{made} could not be renamed to {path}")
    if old is not None:
        fs.delete(old, True)
    return path


def _ranged(schema: T.StructType) -> list[str]:
    """Columns whose ranges are kept: numbers, dates and timestamps."""
    kinds = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return [f.name for f in schema if isinstance(f.dataType, kinds)]


def _measured(table: DataFrame) -> DataFrame:
    """A row per file of a Parquet table that holds rows: ``file`` (its name), ``rows``,
    ``bytes``, and ``least`` and ``greatest`` of its columns."""
    found = table.metadataColumn("_metadata")
    kept = _ranged(table.schema)
    held = table.select(
        found["file_name"].alias("file"), found["file_size"].alias("size"), F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row")
    )
    ends = [
        F.struct(*[how(F.col(f"row.`{c}`")).alias(c) for c in kept]).alias(name)
        for name, how in (("least", F.min), ("greatest", F.max))
        if kept
    ]
    return held.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.max("size").alias("bytes"), *ends)


def _indexed(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame | None, list[str]]:
    """A table's index, if it has one, and its files that the index does not list."""
    files = [unquote(posixpath.basename(f)) for f in spark.read.schema(schema).parquet(path).inputFiles()]
    fs, at = _hadoop(spark, f"{path.rstrip('/')}/{INDEX}")
    if not fs.exists(at):
        return None, files
    index = spark.read.parquet(f"{path.rstrip('/')}/{INDEX}")
    listed = {row.file for row in index.select("file").toLocalIterator()}
    return index, [f for f in files if f not in listed]


def file_ranges(spark: SparkSession, path: str) -> list[dict]:
    """What the index says: a row per file that holds rows with ``file``, ``rows``, ``bytes`` and
    ``ranges``, ``{column: (least, greatest)}``; None for columns without ranges, nothing
    for columns of NULLs. Files that are not in the index are measured."""
    root = path.rstrip("/")
    schema = spark.read.parquet(path).schema
    kept = _ranged(schema)
    index, others = _indexed(spark, path, schema)
    parts = [] if index is None else [index]
    if others:
        parts.append(_measured(spark.read.schema(schema).parquet(*[f"{root}/{f}" for f in others])))

    def end(side: str, c: str) -> Column:
        value = F.col(f"{side}.`{c}`")
        return F.unix_micros(value) if isinstance(schema[c].dataType, T.TimestampType) else value

    found = []
    for part in parts:
        ends = [end(side, c) for c in kept for side in ("least", "greatest")]
        for file, rows, size, *values in part.select("file", "rows", "bytes", *ends).collect():
            ranges: dict[str, tuple | None] = {c: None for c in schema.names if c not in kept}
            for c, low, high in zip(kept, values[::2], values[1::2]):
                if low is not None:
                    ranges[c] = (_stored(low), _stored(high))
            found.append({"file": f"{root}/{file}", "rows": rows, "bytes": size, "ranges": ranges})
    return sorted(found, key=lambda f: f["file"])


def _stored(value) -> float:
    """A value as Parquet stores it: days of a date, microseconds of a timestamp."""
    if isinstance(value, datetime):
        given = value if value.tzinfo else value.replace(tzinfo=timezone.utc)
        since = given - datetime(1970, 1, 1, tzinfo=timezone.utc)
        return (since.days * 86_400 + since.seconds) * 1_000_000 + since.microseconds
    if isinstance(value, date):
        return (value - date(1970, 1, 1)).days
    return value


def read_range(spark: SparkSession, path: str, ranges: dict[str, tuple]) -> DataFrame:
    """Rows of a clustered table with every column within its ``(least, greatest)``,
    bounds included; files whose ranges in the index rule that out are not opened."""
    root = path.rstrip("/")
    schema = spark.read.parquet(path).schema
    kept = set(_ranged(schema))
    index, wanted = _indexed(spark, path, schema)
    if index is not None:
        for c, (low, high) in ranges.items():
            if c in kept:  # a file that has only NULLs goes too
                index = index.filter((F.col(f"greatest.`{c}`") >= F.lit(low)) & (F.col(f"least.`{c}`") <= F.lit(high)))
        wanted = wanted + [row.file for row in index.select("file").orderBy("file").collect()]
    files = [f"{root}/{f}" for f in wanted]
    held = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    for c, (low, high) in ranges.items():
        held = held.filter(F.col(f"`{c}`").between(F.lit(low), F.lit(high)))
    return held
