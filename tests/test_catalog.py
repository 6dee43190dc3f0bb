"""Every catalogue query against its DuckDB SQL on the smallest tables, plus the entry point."""

import os
import sys

import pytest

from metrolens.catalog import ORACLE_SQL, QUERIES, TIMED

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from oracle import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, con, key):
    problems, _, _ = compare(spark, con, key, SF, QUERIES[key], ORACLE_SQL[key])
    assert not problems, problems


@pytest.mark.parametrize("key", sorted(TIMED))
def test_timed_reports(spark, key):
    rows = TIMED[key](spark, SF).collect()
    assert rows and all(r.rows > 0 and r.seconds >= 0 for r in rows)
    if key == "conversion_report":
        return
    assert all(r.same for r in rows)
    groups = {}
    for r in rows:
        groups.setdefault(r.query if key == "api_report" else "", []).append(r)
    for group in groups.values():
        assert [r.relative for r in group if r.fastest] == [1.0]
        assert all(r.relative >= 1.0 for r in group)


def test_entry(spark):
    import __spark_entry__ as entry_mod

    df = entry_mod.entry(spark)
    assert df.columns == ["time_of_day", "street_pct"]
    assert df.count() > 0
    assert set(entry_mod.queries()) >= set(QUERIES)
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.mark.parametrize(
    "key,key_fn",
    [
        ("share_by_bucket", lambda r: (-r.street_pct, r.time_of_day)),
        ("topk_rank", lambda r: (r.year, -r.crime_total, r.ranking, r.month)),
        ("sql_topk", lambda r: (r.year, -r.crime_total, r.ranking)),
        ("ratio_join", lambda r: r.zipcode),
        ("nearest_per_event", lambda r: (-r.crime_count, r.division)),
        ("limit_n", lambda r: (-r.o_totalprice, r.o_orderkey)),
    ],
)
def test_results_come_back_in_stated_order(spark, key, key_fn):
    rows = QUERIES[key](spark, SF).collect()
    assert rows == sorted(rows, key=key_fn)
