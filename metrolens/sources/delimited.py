"""CSV, delimited and plain-text sources and sinks, always under a declared schema."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from metrolens.session import materialize

# What the CSV reader splits at when whole lines are wanted; a line that holds it comes back whole all the same.
_RARE = "\u0001"


def _paths(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def trim_header_names(df: DataFrame) -> DataFrame:
    """Strip stray spaces from column names ('AREA ' vs 'AREA') so by-name unions line up."""
    return df.toDF(*[c.strip() for c in df.columns])


def normalize_column_names(df: DataFrame) -> DataFrame:
    """Lower-case names with runs of spaces and punctuation turned into '_'
    ('TIME OCC' -> 'time_occ', 'Premis Desc' -> 'premis_desc')."""
    def clean(name: str) -> str:
        return re.sub(r"[^0-9a-zA-Z]+", "_", name.strip()).strip("_").lower()

    return df.toDF(*[clean(c) for c in df.columns])


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType | str | None = None,
    sep: str = ",",
    header: bool = True,
    infer_schema: bool = False,
    check_header: bool = True,
    **options: str,
) -> DataFrame:
    """CSV scan. With ``schema`` (the default use) no inference pass runs. The
    columns are bound by position, so a file whose header names others, or the
    same in another order, fails the query unless ``check_header`` is off.
    ``infer_schema=True`` is kept for profiling."""
    reader = spark.read.option("header", header).option("sep", sep)
    if schema is not None and header and check_header:
        reader = reader.option("enforceSchema", False)
    for key, value in options.items():
        reader = reader.option(key, value)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer_schema:
        reader = reader.option("inferSchema", True)
    return trim_header_names(reader.csv(_paths(paths)))


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    n_columns: int,
    sep: str = ";",
    names: Sequence[str] | None = None,
) -> DataFrame:
    """Header + all-string delimited file; columns named ``names`` or ``_c0.._c{n-1}``.

    Address columns by position with :func:`column_at` when headers vary between files.
    """
    names = list(names) if names else [f"_c{i}" for i in range(n_columns)]
    schema = StructType([StructField(n, StringType()) for n in names])
    return read_csv(spark, paths, schema=schema, sep=sep, check_header=False)


def column_at(df: DataFrame, index: int) -> str:
    return df.columns[index]


def read_text(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per line, column ``value``. Splittable, so large files fan out across tasks."""
    return spark.read.text(_paths(paths))


def sample_lines(spark: SparkSession, paths: str | Sequence[str], n: int = 5, width: int = 200) -> DataFrame:
    """The first ``width`` characters of ``n`` lines, for a look at an unknown
    file: no order is asked for, so only as much is read as the lines need."""
    return read_text(spark, paths).limit(n).select(F.substring("value", 1, width).alias("value"))


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """Any ``n`` rows, unsorted (see ``limit_n`` for the first rows of an order)."""
    return df.limit(n)


def split_fields(
    spark: SparkSession,
    paths: str | Sequence[str],
    sep: str = ";",
    min_fields: int = 3,
    keep: Sequence[int] | None = None,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """Hand-delimited parse of text lines: skip blank lines, skip the first
    non-blank line of each file (the header), keep lines with at least
    ``min_fields`` fields, trim every field (an empty field reads as '').

    Splitting and counting are built-in expressions (``split``/``size``), so
    the work stays in the JVM and files split across tasks. Output columns
    are the fields at positions ``keep`` (default: the first ``min_fields``),
    named ``names`` or ``f{i}``.
    """
    keep = list(keep) if keep is not None else list(range(min_fields))
    if max(keep) >= min_fields:
        raise ValueError("keep positions must be below min_fields")
    names = list(names) if names else [f"f{i}" for i in keep]
    # The CSV reader skips blank lines and each file's header line; with quoting
    # off every line is one raw field. A line that does hold the separator has too
    # many fields for the schema, and then the reader gives its text as it stands.
    read = (
        spark.read.schema("field string, whole string")
        .option("columnNameOfCorruptRecord", "whole")
        .option("header", True)
        .option("sep", _RARE)
        .option("quote", "")
        .csv(_paths(paths))
    )
    lines = read.select(F.coalesce("whole", "field").alias("line"))
    parts = F.split(F.col("line"), re.escape(sep), -1)
    return lines.filter(F.size(parts) >= min_fields).select(
        *[F.regexp_replace(F.element_at(parts, i + 1), r"^\s+|\s+$", "").alias(n) for i, n in zip(keep, names)]
    )


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", header).option("sep", sep).csv(path)
    return path


def write_text(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write a single string column, one line per row."""
    if len(df.columns) != 1:
        raise ValueError("write_text needs exactly one string column")
    df.write.mode(mode).text(path)
    return path


def number_lines(spark: SparkSession, paths: str | Sequence[str], name: str = "line_no", skip: int = 0) -> DataFrame:
    """``(line_no, value)``: every line with its 0-based place in the files taken
    one after another in the order of their names, less the first ``skip``.

    No sort: lines are counted per file split (one row each), a running sum over
    those rows gives every split its first number, and the second read counts on
    from there as it streams. The counting job runs when this is called.
    """
    lines = spark.read.text(_paths(paths)).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )
    counts = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(counts, "line-counts")
    files = counts.groupBy("file").agg(F.sum("n").alias("lines"))
    # One row per file, then one per split of a file: no window holds all splits of all files.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum("n").over(inside), F.lit(0))
    starts = counts.select("file", "block", own.alias("own")).join(files, "file")
    starts = starts.select("file", "block", (F.col("own") + F.col("before")).alias("first"))

    def count_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], int] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            files, blocks = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            cuts = np.flatnonzero((files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])) + 1
            edges = [0, *cuts.tolist(), batch.num_rows]
            place = np.empty(batch.num_rows, np.int64)
            for a, b in zip(edges, edges[1:]):
                key = (files[a], int(blocks[a]))
                place[a:b] = np.arange(b - a) + held.get(key, 0)
                held[key] = held.get(key, 0) + b - a
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], names=["value", "file", "block", "place"])

    placed = lines.mapInArrow(count_on, "value string, file string, block long, place long")
    numbered = placed.join(starts, ["file", "block"]).select((F.col("first") + F.col("place")).alias(name), "value")
    return numbered.filter(F.col(name) >= skip) if skip else numbered
