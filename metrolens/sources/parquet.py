"""Parquet sink and scan; the CSV-to-Parquet conversion job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from metrolens.operators.setops import union_all
from metrolens.sources.delimited import normalize_column_names, read_csv


def to_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] | None = None,
    mode: str = "overwrite",
) -> str:
    """Write ``df`` as Parquet; ``partition_by`` enables partition pruning on later reads.

    Partitioned rows are first gathered by their value, so a task writes few
    folders; adaptive execution splits a value that holds too much for one task.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def convert_csv_to_parquet(
    spark: SparkSession,
    csv_paths: Sequence[str],
    schema: StructType | str,
    out_path: str,
    partition_by: Sequence[str] | None = None,
    normalize_names: bool = False,
) -> DataFrame:
    """Read several CSV files under one schema, union them by name, write Parquet,
    and return the Parquet read of the result (lazy).

    ``normalize_names`` rewrites names such as 'TIME OCC' to 'time_occ' first
    (``partition_by`` then refers to the rewritten names)."""
    union = union_all([read_csv(spark, p, schema=schema) for p in csv_paths])
    if normalize_names:
        union = normalize_column_names(union)
    to_parquet(union, out_path, partition_by)
    return spark.read.parquet(out_path)
