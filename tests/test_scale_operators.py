"""Operators for hot keys and large results: against plain Python, over several partitionings."""

import math
import random
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from metrolens.operators import bucket_diff, diff_tables, exact_stats, rank_all, skew_join
from metrolens.plans import executed_join_nodes, moved, node_runs, plan_text
from metrolens.plans.explain import final_plan


# ---------------------------------------------------------------- joins with a key hot on both sides


def _sides(spark, n_left, n_right, copies=False):
    key = lambda n: F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 40 + 100)
    same = lambda c: F.lit(1) if copies else F.col(c)
    left = spark.range(0, n_left, 1, 4).select(key(n_left).cast("int").alias("k"), same("id").alias("a"))
    right = spark.range(0, n_right, 1, 3).select(key(n_right).cast("int").alias("k"), same("id").alias("b"))
    return left, right


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("copies", [False, True])
def test_skew_join_equals_the_plain_join(spark, how, copies):
    left, right = _sides(spark, 900, 300, copies)
    got = skew_join(left, right, ["k"], how, tasks=8)
    want = left.join(right, ["k"], how)
    assert got.columns == want.columns
    assert Counter(got.collect()) == Counter(want.collect())


def test_skew_join_keys_on_one_side_only(spark):
    left = spark.range(600).select(F.lit("x").alias("k"), F.col("id").alias("k2"), F.col("id").alias("a"))
    left = left.unionAll(spark.range(300).selectExpr("'hot'", "1", "id"))
    right = spark.createDataFrame([("hot", 2, 1), ("y", 5, 2), ("x", 5, 3)], "k string, k2 long, b long")
    for how in ("inner", "left"):
        assert Counter(skew_join(left, right, ["k", "k2"], how, tasks=4).collect()) == Counter(
            left.join(right, ["k", "k2"], how).collect()
        )


def test_skew_join_empty_and_null_sides(spark):
    left, right = _sides(spark, 200, 100)
    none = left.filter("a < 0")
    nulls = spark.range(100).select(F.lit(None).cast("int").alias("k"), F.col("id").alias("b"))
    assert skew_join(none, right, ["k"], tasks=8).count() == 0
    assert skew_join(left, right.filter("b < 0"), ["k"], "left", tasks=8).count() == left.count()
    assert skew_join(left, nulls, ["k"], "left", tasks=8).count() == left.count()
    assert skew_join(left, nulls, ["k"], tasks=8).count() == 0
    with pytest.raises(ValueError):
        skew_join(left, right, ["k"], "full")


def test_a_hot_key_spreads_over_the_tasks(spark):
    """Without the grid one task makes nearly all pairs."""
    left, right = _sides(spark, 6000, 900)
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def busiest(df):
            per_task = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
            return max(per_task) * 8 / sum(per_task)

        dealt = skew_join(left, right, ["k"], tasks=8)
        assert busiest(dealt) <= 2
        assert busiest(left.join(right, ["k"])) > 6
        assert "CartesianProduct" not in plan_text(dealt, "simple")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_skew_join_deals_cells_by_their_pairs(spark):
    """Few rows of many pairs: cells and tasks follow the pairs, whatever the number of tasks."""
    left, right = _sides(spark, 3000, 1500)
    dealt = skew_join(left, right, ["k"], tasks=4, pairs=10_000)  # 500,000 pairs of the key 7
    want = left.join(right, ["k"])
    totals = [F.count(F.lit(1)), F.sum("a"), F.sum("b"), F.sum(F.col("a") * F.col("b"))]
    assert dealt.agg(*totals).first() == want.agg(*totals).first()
    per_task = dealt.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(per_task) > 20 and max(r["count"] for r in per_task) < 10_000 * 10


def test_skew_join_makes_all_pairs_in_one_join(spark):
    """No pair passes a union, and no side is broadcast once its rows are copied."""
    left, right = _sides(spark, 3000, 1500)
    dealt = skew_join(left, right, ["k"], tasks=4, pairs=10_000)
    want = left.join(right, ["k"])
    total = lambda df: df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("a") * F.col("b")).alias("ab"))
    got = total(dealt)
    assert Counter(got.collect()) == Counter(total(want).collect())
    plan = final_plan(got)
    assert executed_join_nodes(got)[0] == "SortMergeJoin" and plan.count("SortMergeJoin") == 1
    assert 0 <= plan.index("SortMergeJoin") < plan.index("Union")


# ---------------------------------------------------------------- ranks of all rows


def _plain_ranks(rows, keys, order):
    """(row, rank, dense) for rows of (key..., value...) in the given order."""
    out = []
    for i, r in enumerate(rows):
        group = [s for s in rows if s[:keys] == r[:keys]]
        ahead = [s for s in group if order(s) < order(r)]
        out.append((r, len(ahead) + 1, len({order(s) for s in ahead}) + 1))
    return Counter(out)


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_rank_all_against_plain(spark, parts):
    rnd = random.Random(parts)
    rows = [(rnd.choice(["hot", "hot", "a", None]), rnd.choice([None, 1, 1, 2, 3]), rnd.choice([1.5, -0.5, None])) for _ in range(240)]
    df = spark.createDataFrame(rows, "k string, v int, w double").repartition(4)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = rank_all(df, ["k"], [("v", "DESC"), ("w", "ASC")]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    # Spark puts NULL first upwards and last downwards
    order = lambda r: (r[1] is None, -(r[1] or 0), r[2] is not None, r[2] or 0)
    assert Counter((tuple(r)[:3], r.rank, r.dense_rank) for r in got) == _plain_ranks(rows, 1, order)
    for k in {r.k for r in got}:
        group = sorted((r for r in got if r.k == k), key=lambda r: r.row_number)
        assert [r.row_number for r in group] == list(range(1, len(group) + 1))
        assert [order(tuple(r)[:3]) for r in group] == sorted(order(tuple(r)[:3]) for r in group)
    if parts > 1:
        used = rank_all(df, ["k"], [("v", "DESC")])
        assert "Window" not in plan_text(used, "simple")


def test_rank_all_one_group_of_equal_rows(spark):
    df = spark.range(0, 500, 1, 4).select(F.lit("g").alias("k"), F.lit(float("nan")).alias("v"))
    got = rank_all(df, ["k"], [("v", "ASC")]).collect()
    assert {(r.rank, r.dense_rank) for r in got} == {(1, 1)}
    assert sorted(r.row_number for r in got) == list(range(1, 501))
    assert rank_all(df.limit(0), ["k"], [("v", "ASC")]).collect() == []
    with pytest.raises(ValueError):
        rank_all(df, ["k"], [("v", "up")])


# ---------------------------------------------------------------- equality by buckets


def test_bucket_diff_equals_diff_tables(spark):
    a = spark.range(0, 2000, 1, 3).selectExpr("id % 700 AS x", "IF(id % 9 = 0, NULL, CAST(id % 5 AS STRING)) AS y", "id % 3 = 0 AS z")
    b = a.filter("x <> 13").unionAll(a.filter("x = 20")).select("z", "x", "y").repartition(5)
    assert Counter(bucket_diff(a, b, buckets=64).collect()) == Counter(diff_tables(a, b).collect())
    assert bucket_diff(a, b).count() > 0
    assert bucket_diff(a, a.repartition(7)).count() == 0
    assert bucket_diff(a, a.limit(0)).agg(F.sum("copies")).first()[0] == 2000
    assert bucket_diff(a.limit(0), a.limit(0)).count() == 0
    with pytest.raises(ValueError):
        bucket_diff(a, a.drop("z"))


def test_equal_inputs_move_bucket_rows_only(spark):
    a = spark.range(0, 50_000, 1, 4).selectExpr("id", "id * 7 AS v")
    b = spark.range(0, 50_000, 1, 7).selectExpr("id", "id * 7 AS v")
    same, plain = bucket_diff(a, b, buckets=16), diff_tables(a, b)
    assert same.collect() == [] and plain.collect() == []
    assert moved(same).shuffle_bytes * 20 < moved(plain).shuffle_bytes


# ---------------------------------------------------------------- what a run moved


def test_metrics_of_a_run(spark):
    left = spark.range(0, 1000, 1, 4).selectExpr("id % 10 AS k", "id")
    right = spark.range(0, 20, 1, 2).selectExpr("id AS k", "id AS b").hint("merge")
    df = left.join(right, "k").groupBy("k").count()
    df.collect()
    got = moved(df)
    assert executed_join_nodes(df) == ["SortMergeJoin"] and got.join_rows == [1000]
    assert got.shuffle_bytes > 0 and got.spilled_bytes == 0
    runs = node_runs(df)
    assert [r.rows for r in runs if r.node == "SortMergeJoin"] == [1000]
    assert any(r.shuffle_bytes for r in runs) and runs[0].depth == 0
    scan = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").agg(F.sum("o_orderkey"))
    scan.collect()
    assert moved(scan).read_rows == 1500 and moved(scan).join_rows == []


# ---------------------------------------------------------------- exact sums


def test_exact_stats_do_not_depend_on_the_partitioning(spark):
    rnd = random.Random(4)
    values = [rnd.choice([1e300, -1e300, 1e-300, 5e-324, 0.1, -0.0, 1.0, 2.0**52, -(2.0**-1022)]) * rnd.random() for _ in range(400)]
    rows = [("ab"[i % 2], v) for i, v in enumerate(values)] + [("c", None), ("c", None), ("d", 0.0), ("d", None)]
    rows += [("e", float("nan")), ("e", 1.0), ("f", float("inf")), ("f", 2.0), ("g", float("inf")), ("g", -float("inf"))]
    rows += [("h", 1.7e308), ("h", 1.7e308), (None, 0.1), (None, 0.2), ("i", -float("inf"))]
    seen = set()
    for parts in (1, 3, 11):
        df = spark.createDataFrame(rows, "k string, v double").repartition(parts, F.rand(parts))
        got = {r.k: (r.n, r.sum, r.avg) for r in exact_stats(df, ["k"], "v").collect()}
        seen.add(str(sorted(got.items(), key=str)))
    assert len(seen) == 1
    for k in ("a", "b", None, "d"):
        given = [Fraction(v) for x, v in rows if x == k and v is not None]
        total = sum(given)
        assert got[k] == (len(given), float(total), float(total / len(given)))
    assert got["c"] == (0, None, None) and got["f"][1:] == (math.inf, math.inf) and got["i"][1] == -math.inf
    assert math.isnan(got["e"][1]) and math.isnan(got["g"][2])
    assert got["h"] == (2, math.inf, 1.7e308)


def test_exact_stats_against_fsum(spark):
    rnd = random.Random(8)
    values = [rnd.uniform(-1, 1) * 10 ** rnd.randint(-20, 20) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    (got,) = exact_stats(df, [], F.col("v")).collect()
    assert got.sum == math.fsum(values) and got.n == 3000
    assert exact_stats(df.limit(0), ["v"], "v").count() == 0
