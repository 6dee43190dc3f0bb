"""Literal-row fixtures for the scalar functions (FIXTURES.md section 2)."""

import pytest
from pyspark.sql import functions as F

from metrolens.functions import (
    date_parts,
    haversine_km,
    haversine_km_udf,
    parse_currency,
    time_of_day,
    time_of_day_udf,
)

BUCKET_CASES = [
    (0, "Night"), (459, "Night"), (499, "Night"), (500, "Morning"), (1159, "Morning"),
    (1160, "Night"), (1200, "Afternoon"), (1659, "Afternoon"), (1660, "Night"),
    (1700, "Evening"), (2059, "Evening"), (2060, "Night"), (2359, "Night"), (-1, "Night"),
]


def test_time_of_day_bands(spark):
    df = spark.createDataFrame(BUCKET_CASES + [(None, None)], "t int, expected string")
    got = {r.t: r.label for r in df.select("t", time_of_day("t").alias("label")).collect()}
    for t, expected in BUCKET_CASES:
        assert got[t] == expected, t
    assert got[None] == "Night"


@pytest.mark.parametrize("policy,expected", [("default", "Night"), ("group", None), ("drop", None)])
def test_time_of_day_null_policy(spark, policy, expected):
    df = spark.createDataFrame([(None,)], "t int")
    assert df.select(time_of_day("t", policy).alias("x")).first().x == expected


def test_time_of_day_udf_matches_expression(spark):
    df = spark.createDataFrame([(t,) for t, _ in BUCKET_CASES] + [(None,)], "t int")
    rows = df.select("t", time_of_day("t", "group").alias("a"), time_of_day_udf("t").alias("b")).collect()
    assert all(r.a == r.b for r in rows)


def test_text_int_is_null_not_error(spark):
    df = spark.createDataFrame([("1200.0",), ("0830",), ("abc",)], "s string")
    got = [r.v for r in df.select(F.col("s").try_cast("int").alias("v")).collect()]
    assert got == [None, 830, None]


def test_date_parts(spark):
    df = spark.createDataFrame(
        [("2010 Feb 20 12:00:00 AM",), ("2010 FEB 20 12:00:00 AM",), ("02/20/2010",), (None,)], "d string"
    )
    y, m = date_parts("d")
    got = [(r.y, r.m) for r in df.select(y.alias("y"), m.alias("m")).collect()]
    assert got == [(2010, 2), (2010, None), (None, None), (None, None)]


CURRENCY = [
    ("$45,000", 45000.0, 45000.0),
    ("$1,234.50", 1234.5, 1234.5),
    ("---", None, None),
    ("", None, None),
    (None, None, None),
    ("-5", -5.0, None),
    ("1.2.3", None, None),
    (" $7,000 ", 7000.0, 7000.0),
    (".5", 0.5, 0.5),
]


def test_currency_lenient_and_strict(spark):
    df = spark.createDataFrame([(c[0],) for c in CURRENCY], "raw string")
    rows = df.select(
        parse_currency("raw").alias("lenient"), parse_currency("raw", strict=True).alias("strict")
    ).collect()
    for (raw, lenient, strict), row in zip(CURRENCY, rows):
        assert row.lenient == lenient, raw
        assert row.strict == strict, raw


def test_currency_never_fails_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame([("---",), ("n/a",)], "raw string")
    assert df.select(parse_currency("raw").alias("x")).filter("x IS NOT NULL").count() == 0


def test_haversine_values(spark):
    df = spark.createDataFrame(
        [(34.05, -118.25, 34.10, -118.30), (0.0, 0.0, 0.0, 180.0), (1.0, 2.0, 1.0, 2.0), (None, 1.0, 2.0, 3.0)],
        "a double, b double, c double, d double",
    )
    rows = df.select(
        haversine_km("a", "b", "c", "d").alias("km"), haversine_km_udf("a", "b", "c", "d").alias("km_udf")
    ).collect()
    assert rows[0].km == pytest.approx(7.219302, abs=1e-6)
    assert rows[1].km == pytest.approx(20015.086796, abs=1e-6)
    assert rows[2].km == 0.0
    assert rows[3].km is None and rows[3].km_udf is None
    for r in rows[:3]:
        assert r.km_udf == pytest.approx(r.km, abs=1e-9)


def test_date_parts_parse_mode(spark):
    df = spark.createDataFrame(
        [("2010 Feb 20 12:00:00 AM",), ("2010 FEB 20 12:00:00 AM",), ("2010 Feb 30 12:00:00 AM",), ("02/20/2010",)],
        "d string",
    )
    y, m = date_parts("d", mode="parse")
    got = [(r.y, r.m) for r in df.select(y.alias("y"), m.alias("m")).collect()]
    assert got == [(2010, 2), (2010, 2), (None, None), (None, None)]
    y, m = date_parts("d")
    assert [(r.y, r.m) for r in df.select(y.alias("y"), m.alias("m")).collect()][2] == (2010, 2)


def test_cluster_conf_sizes_partitions():
    from metrolens.session import cluster_conf

    conf = cluster_conf(shuffle_bytes=20e12, total_cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 74506
    assert int(cluster_conf(1e6, 16)["spark.sql.shuffle.partitions"]) == 32
    assert int(cluster_conf(1e18, 16)["spark.sql.shuffle.partitions"]) == 100_000
