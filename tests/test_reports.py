"""Measured comparisons: what they count, compare and rank."""

from metrolens.plans import measure, variant_report


def test_variants_are_compared_and_ranked(spark):
    import time

    def slow():
        time.sleep(0.3)
        return spark.range(10)

    report = variant_report(
        spark, "form", {"a": lambda: spark.range(10), "b": slow, "c": lambda: spark.range(9)}, repeats=3
    )
    rows = {r.form: r for r in report.collect()}
    assert [rows[k].rows for k in "abc"] == [10, 10, 9]
    assert [rows[k].same for k in "abc"] == [True, True, False]
    assert not rows["b"].fastest and rows["b"].relative > 1
    assert [r.relative for r in rows.values() if r.fastest] == [1.0]


def test_runs_rotate(spark):
    order = []

    def form(name):
        def build():
            order.append(name)
            return spark.range(1)

        return build

    found = measure({n: form(n) for n in "xyz"}, repeats=3, warmup=False)
    assert order == list("xyz" "yzx" "zxy")
    assert all(len(m.seconds) == 3 for m in found.values())


def test_same_rows_in_another_order_count_as_same(spark):
    from pyspark.sql import functions as F

    df = spark.range(100).withColumn("v", F.col("id") * 2)
    report = variant_report(
        spark, "form", {"up": lambda: df, "down": lambda: df.orderBy(F.desc("id"))}, repeats=1, warmup=False
    )
    assert all(r.same for r in report.collect())
