"""Incremental C1 over files that keep arriving."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from metrolens.functions import time_of_day
from metrolens.operators.aggregates import share_by
from metrolens.session import staging_path


def read_parquet_stream(
    spark: SparkSession, path: str, schema: StructType | str, max_files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def street_share_stream(stream: DataFrame, null_policy: str = "default") -> DataFrame:
    """C1 as a streaming aggregate (state: one row per time band)."""
    return share_by(
        stream, time_of_day("time_occ", null_policy), F.col("premis_desc") == "STREET", "time_of_day", "street_pct",
        null_policy,
    )


def run_available(aggregate: DataFrame, output_path: str, checkpoint_location: str | None = None) -> StreamingQuery:
    """Process every file available now, then stop.

    Each micro-batch's complete result is a folder ``batch=<id>`` of its own
    under ``output_path`` (:func:`read_latest` reads the last), so a failure
    never loses the result before it; progress and state live in
    ``checkpoint_location`` (default: a fresh folder under the shared checkpoint
    folder), so a restart resumes where it stopped.
    """
    spark = aggregate.sparkSession
    location = checkpoint_location or staging_path(spark, "stream-checkpoint")

    def keep(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output_path}/batch={epoch}")

    query = (
        aggregate.writeStream.outputMode("complete")
        .foreachBatch(keep)
        .option("checkpointLocation", location)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def read_latest(spark: SparkSession, output_path: str) -> DataFrame:
    """The result after the last finished micro-batch."""
    batches = spark.read.parquet(output_path)
    last = batches.agg(F.max("batch").alias("batch"))
    return batches.join(F.broadcast(last), "batch", "left_semi").drop("batch")


__all__ = ["read_latest", "read_parquet_stream", "run_available", "street_share_stream"]
