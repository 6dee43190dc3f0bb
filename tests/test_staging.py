"""Scopes of staged tables."""

import os

import pytest
from pyspark.sql import functions as F

from metrolens.catalog import QUERIES
from metrolens.session import checkpoint_dir, materialize
from metrolens.staging import content_key, stage_shared, staging_scope

SF = "/root/testdata/sf0.001"


def _staged(spark):
    root = checkpoint_dir(spark).removeprefix("file:") + "/staging"
    return {os.path.join(d, f) for d, _, files in os.walk(root) for f in files if f.endswith(".parquet")}


@pytest.mark.parametrize("key", ["rank_all", "nearest_far", "geojson_oneline"])
def test_a_query_leaves_nothing_behind(spark, key):
    before = _staged(spark)
    with staging_scope(spark):
        rows = QUERIES[key](spark, SF).collect()
        assert rows and _staged(spark) > before
    assert _staged(spark) == before


def test_a_second_run_reuses_until_the_last_reader_ends(spark):
    query = lambda: spark.read.parquet(f"{SF}/orders.parquet").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("t"))
    before = _staged(spark)
    with staging_scope(spark):
        first = stage_shared(query(), "sums")
        want = sorted(first.collect())
        files = _staged(spark) - before
        with staging_scope(spark):
            again = stage_shared(query(), "sums")
            assert _staged(spark) - before == files  # nothing was written again
            assert sorted(again.collect()) == want
        assert _staged(spark) - before == files and sorted(first.collect()) == want
        other = stage_shared(query().filter("t > 0"), "sums")
        assert other.count() and len(_staged(spark) - before) > len(files)
    assert _staged(spark) == before


def test_content_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    df = lambda: spark.read.parquet(path).filter("id > 3")
    key = content_key(df())
    assert content_key(df()) == key != content_key(spark.read.parquet(path).filter("id > 4"))
    spark.range(11).write.mode("overwrite").parquet(path)
    assert content_key(df()) != key


def test_scopes_end_after_a_failure_and_shared_tables_need_one(spark):
    before = _staged(spark)
    with pytest.raises(ZeroDivisionError):
        with staging_scope(spark):
            materialize(spark.range(5), "x")
            raise ZeroDivisionError
    assert _staged(spark) == before
    with pytest.raises(RuntimeError):
        stage_shared(spark.range(5), "x")
    outside = materialize(spark.range(5), "kept")
    assert outside.count() == 5
