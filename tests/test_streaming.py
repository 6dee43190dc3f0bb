"""The streaming form of C1 gives the batch answer once all files are processed."""

from pyspark.sql import functions as F

from metrolens.catalog import INCIDENT_SCHEMA, street_share
from metrolens.session import staging_path
from metrolens.sources import incidents
from metrolens.streaming import read_latest, read_parquet_stream, run_available, street_share_stream

SF = "/root/testdata/sf0.001"


def test_stream_matches_batch(spark):
    inc = incidents(spark, SF)
    source = staging_path(spark, "stream-source")
    # Two arrivals, like the reference's two incident files.
    inc.filter(F.col("event_id") % 2 == 0).write.parquet(f"{source}/part=a")
    inc.filter(F.col("event_id") % 2 == 1).write.parquet(f"{source}/part=b")
    stream = read_parquet_stream(spark, f"{source}/*", INCIDENT_SCHEMA, max_files_per_trigger=1)
    out = staging_path(spark, "stream-out")
    run_available(street_share_stream(stream), out)
    got = sorted(tuple(r) for r in read_latest(spark, out).collect())
    want = sorted(tuple(r) for r in street_share(inc).collect())
    assert got == want
    # every batch kept its own result
    assert spark.read.parquet(out).select("batch").distinct().count() >= 2
