"""Form equivalence: each query's alternative forms give the same rows with
the same multiplicities (diff_tables in both directions is empty)."""

import pytest

from metrolens.catalog import QUERIES
from metrolens.operators import diff_tables

SF = "/root/testdata/sf0.001"

PAIRS = [
    ("topk_rank", "sql_topk"),
    ("topk_rank", "sql_topk_view"),
    ("share_by_bucket", "share_by_bucket_sql"),
    ("share_by_bucket", "share_by_bucket_csv"),
    ("share_by_bucket_group", "share_by_bucket_udf"),
    ("haversine", "haversine_udf"),
    ("inner_join", "join_merge"),
    ("inner_join", "join_shuffle_hash"),
    ("inner_join", "join_broadcast"),
    ("ratio_join", "ratio_join_geojson"),
    ("nearest_per_location", "nearest_csv_sites"),
    ("union_all", "union_by_position"),
    ("union_all", "csv_scan"),
    ("union_all", "parquet_roundtrip"),
    ("geojson_features", "geojson_document"),
    ("date_parts", "date_parts_parsed"),
]


@pytest.mark.parametrize("left,right", PAIRS)
def test_forms_agree(spark, left, right):
    a = QUERIES[left](spark, SF)
    b = QUERIES[right](spark, SF)
    b = b.select(*a.columns)
    diff = diff_tables(a, b).collect()
    assert diff == [], diff[:5]
