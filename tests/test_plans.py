"""Plan assertions: native forms stay in the JVM, hints pick the stated join,
filters and projections reach the scan, no cross product anywhere."""

import pytest

from metrolens.catalog import QUERIES, per_capita
from metrolens.plans import executed_join_nodes, plan_text

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython")


def test_native_share_has_no_python(spark):
    df = QUERIES["share_by_bucket"](spark, SF)
    df.collect()
    plan = plan_text(df)
    assert not any(n in plan for n in PYTHON_NODES)
    assert "isFinalPlan=true" in plan and "[codegen id : " in plan


def test_udf_share_uses_arrow(spark):
    plan = plan_text(QUERIES["share_by_bucket_udf"](spark, SF))
    assert "ArrowEvalPython" in plan and "BatchEvalPython" not in plan


def test_scan_pruning(spark):
    # Only event_id is read: the latitude is derived from it.
    assert "ReadSchema: struct<event_id:bigint>" in plan_text(QUERIES["filter_not_null"](spark, SF))


def test_filter_pushdown(spark):
    plan = plan_text(QUERIES["except_distinct"](spark, SF))
    assert "LessThan(o_orderdate," in plan
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz,o_orderpriority:string>" in plan


def test_topk_uses_window_group_limit(spark):
    assert "WindowGroupLimit" in plan_text(QUERIES["topk_rank"](spark, SF))


@pytest.mark.parametrize(
    "strategy,node",
    [("broadcast", "BroadcastHashJoin"), ("merge", "SortMergeJoin"), ("shuffle_hash", "ShuffledHashJoin")],
)
def test_join_hint_takes_effect(spark, strategy, node):
    df = per_capita(spark, SF, strategy)
    df.collect()
    assert executed_join_nodes(df) == [node]


@pytest.mark.parametrize("strategy", ["DEFAULT", "broadcast", "merge", "shuffle_hash"])
@pytest.mark.parametrize("n_sites", [1, 25, 2000])
def test_no_cross_product_at_any_level_of_nearest(spark, monkeypatch, strategy, n_sites):
    # The walk over all levels of the index is one plan: every join that ran is in it.
    from pyspark.sql import functions as F

    from metrolens.operators import assign_nearest, nearest

    monkeypatch.setattr(nearest, "FAN", 16)
    sites = spark.range(n_sites).select("id", (F.col("id") % 83).cast("double").alias("la"), (F.col("id") / 7).alias("lo"))
    points = spark.range(300).select((F.col("id") % 90).cast("double").alias("a"), (F.col("id") * 1.1).alias("o"))
    df = assign_nearest(points, sites, "a", "o", "id", "la", "lo", strategy=strategy)
    assert len(df.collect()) == 300
    joins = executed_join_nodes(df)
    levels = 1 if n_sites <= 16 else 2 if n_sites <= 256 else 3
    assert len(joins) == (1 if levels == 1 else 2 * levels)  # a lone leaf needs no walk
    hinted = {"broadcast": "BroadcastHashJoin", "merge": "SortMergeJoin", "shuffle_hash": "ShuffledHashJoin"}
    assert set(joins) <= ({hinted[strategy]} if strategy in hinted else set(hinted.values()))


def test_except_distinct_folds_before_its_only_exchange(spark):
    from metrolens.operators import except_distinct

    a = spark.range(100).selectExpr("id % 7 AS x", "cast(null as string) AS y")
    df = except_distinct(a, a.filter("x < 3"))
    assert sorted(r.x for r in df.collect()) == [3, 4, 5, 6]
    plan = plan_text(df, "simple").split("== Initial Plan ==")[-1]
    assert plan.count("Exchange") == 1 and "Join" not in plan
    assert plan.index("Exchange") < plan.index("partial_max")


def test_rejected_strategy(spark):
    from metrolens.operators import hinted_join

    a = spark.range(3)
    with pytest.raises(ValueError):
        hinted_join(a, a, "id", strategy="shuffle_replicate_nl")


def test_partitioned_parquet_prunes_partitions(spark):
    from pyspark.sql import functions as F

    df = QUERIES["parquet_roundtrip"](spark, SF).filter(F.col("o_orderstatus") == "F")
    plan = plan_text(df)
    assert "PartitionFilters: [isnotnull(o_orderstatus" in plan and "(o_orderstatus" in plan


def test_forced_broadcast_is_size_checked(spark):
    from pyspark.sql import functions as F

    from metrolens.operators.joins import BroadcastRefused, fits_broadcast, with_strategy

    side = spark.range(100).select("id", F.repeat(F.lit("x"), 50).alias("pad"))
    # 16 bytes for the number and 50 for the text.
    assert fits_broadcast(side, max_rows=100, max_bytes=100 * 66)
    assert not fits_broadcast(side, max_rows=99, max_bytes=100 * 66)
    assert not fits_broadcast(side, max_rows=100, max_bytes=100 * 66 - 1)
    # Over the byte bound the side comes back without the hint, and that is told.
    with pytest.warns(BroadcastRefused):
        assert with_strategy(side, "broadcast", max_broadcast_rows=100, max_broadcast_bytes=100 * 60) is side
    assert with_strategy(side, "broadcast", max_broadcast_rows=100, max_broadcast_bytes=100 * 100) is not side


def test_empty_side_fits_broadcast(spark):
    from metrolens.operators.joins import fits_broadcast

    assert fits_broadcast(spark.range(10).filter("id < 0"), max_rows=0, max_bytes=0)


def test_every_python_step_of_the_nearest_walk_is_a_stage_of_its_own(spark, monkeypatch):
    # Python steps of one stage run side by side, each in a worker of its own per core.
    from pyspark.sql import functions as F

    from metrolens.operators import assign_nearest, nearest

    monkeypatch.setattr(nearest, "FAN", 4)
    monkeypatch.setattr(nearest, "PIECE", 5)  # results handed on in pieces are whole
    sites = spark.range(60).select("id", (F.col("id") % 83).cast("double").alias("la"), (F.col("id") / 7).alias("lo"))
    points = spark.range(300).select((F.col("id") % 90).cast("double").alias("a"), (F.col("id") * 1.1).alias("o"))
    df = assign_nearest(points, sites, "a", "o", "id", "la", "lo", strategy="broadcast")
    assert len(df.collect()) == 300
    lines = plan_text(df, "simple").split("== Initial Plan ==")[0].splitlines()
    nodes = [n for line in lines for n in ("MapInArrow", "Exchange") if n in line and "BroadcastExchange" not in line]
    assert nodes.count("MapInArrow") >= 4
    assert all(nodes[i + 1] == "Exchange" for i, n in enumerate(nodes[:-1]) if n == "MapInArrow")
