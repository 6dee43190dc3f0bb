import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from sql import rows, rows_of  # noqa: E402

from metrolens.llm import sharding  # noqa: E402

COLUMNS = ("n_bytes", "shard", "depth", "shard_bytes", "shard_docs", "oversize")


@pytest.mark.parametrize("limit", [1_000, 20_000, 1 << 30])
def test_sql_agrees(spark, limit):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = sharding.assign_shards(docs, limit=limit).withColumnRenamed("id", "doc_id")
    assert rows(got, "doc_id", *COLUMNS) == rows_of(sharding.oracle_sql(limit), documents=docs)


def check(found, limit):
    """Shards are prefixes of no other shard, fit, and add up."""
    got = found.collect()
    shards = {}
    for r in got:
        shards.setdefault(r.shard, []).append(r)
    for name, docs in shards.items():
        size = sum(r.n_bytes for r in docs)
        assert {(r.depth, r.shard_bytes, r.shard_docs, r.oversize) for r in docs} == {
            (len(name), size, len(docs), size > limit)
        }
        assert size <= limit or len(docs) == 1
        assert not any(other != name and other.startswith(name) for other in shards)
    return got


def test_awkward_rows(documents, awkward):
    docs = documents(awkward, [("shard", "a"), ("row", "b"), ("parent", "c")])
    got = check(sharding.assign_shards(docs, limit=400), 400)
    assert sorted(str(r.id) for r in got) == sorted(str(r[0]) for r in awkward)


def test_repeated_ids_part_on_their_rows(documents):
    docs = documents([(1, "x" * 100)] * 300 + [(None, "y" * 50)] * 100)
    check(sharding.assign_shards(docs, limit=1000), 1000)


def test_written_shards(spark, documents, awkward, tmp_path):
    docs = documents(awkward)
    sharding.write_shards(docs, str(tmp_path / "shards"), limit=400)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert rows(back.select(*docs.columns)) == rows(docs)
    assert back.select("shard").distinct().count() > 3


def test_empty_table_and_plan(documents):
    found = sharding.assign_shards(documents([]))
    assert found.count() == 0
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
