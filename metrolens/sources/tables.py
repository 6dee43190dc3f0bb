"""The driver's parquet tables and the civic-data views derived from them.

The reference reads crime incidents, police stations, census blocks and an
income table. Those inputs are modelled as views over the given tables (see
FIXTURES.md section 3); everything here is a lazy projection, so Catalyst
prunes columns and pushes filters into the parquet scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metrolens.functions.dates import MONTH_ABBREVIATIONS

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crime incidents: HHMM time (some NULL), premises, point (some NULL lat), repeated coordinates."""
    e = read_table(spark, sf_dir, "events", ["event_id", "ts", "event_type"])
    eid = F.col("event_id")
    return e.select(
        eid,
        F.when(eid % 97 == 0, F.lit(None).cast("int"))
        .otherwise((F.hour("ts") * 100 + F.minute("ts")).cast("int"))
        .alias("time_occ"),
        F.when(F.col("event_type") == "error", F.lit("STREET")).otherwise(F.upper("event_type")).alias("premis_desc"),
        F.when(eid % 101 == 0, F.lit(None).cast("double"))
        .otherwise(F.lit(33.7) + (eid % 700).cast("double") / F.lit(1000.0))
        .alias("crime_lat"),
        (F.lit(-118.6) + ((eid * 7) % 600).cast("double") / F.lit(1000.0)).alias("crime_lon"),
    )


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Police stations: division name and point."""
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    k = F.col("n_nationkey")
    return n.select(
        F.col("n_name").alias("division"),
        (F.lit(-118.6) + ((k * 37) % 25).cast("double") * F.lit(0.024)).alias("station_lon"),
        (F.lit(33.7) + ((k * 11) % 25).cast("double") * F.lit(0.028)).alias("station_lat"),
    )


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Census blocks: ZIP (some NULL) and population (some 0); readers must drop the falsy ones."""
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    key = F.col("c_custkey")
    return c.select(
        F.when(key % 53 == 0, F.lit(None).cast("string"))
        .otherwise((F.lit(90000) + F.col("c_nationkey")).cast("string"))
        .alias("zcta"),
        F.when(key % 41 == 0, F.lit(0).cast("bigint")).otherwise((key % 900 + 1).cast("bigint")).alias("pop"),
    )


def income(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median income per ZIP as formatted text: '$23,137', '---' or NULL."""
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    k = F.col("n_nationkey")
    money = F.concat(
        F.lit("$"),
        (F.lit(20) + k * 3).cast("string"),
        F.lit(","),
        F.lpad(((k * 137) % 1000).cast("string"), 3, "0"),
    )
    return n.select(
        (F.lit(90000) + k).cast("string").alias("zip_code"),
        F.col("n_name").alias("community"),
        F.when(k % 6 == 0, F.lit("---"))
        .when(k % 7 == 3, F.lit(None).cast("string"))
        .otherwise(money)
        .alias("median_income_raw"),
    )


def orders_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the order date rendered as incident-style text ('1996 Mar 07 12:00:00 AM')."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"])
    months = F.array(*[F.lit(m) for m in MONTH_ABBREVIATIONS])
    return o.select(
        "o_orderkey",
        F.concat(
            F.year("o_orderdate").cast("string"),
            F.lit(" "),
            F.element_at(months, F.month("o_orderdate")),
            F.lit(" "),
            F.lpad(F.dayofmonth("o_orderdate").cast("string"), 2, "0"),
            F.lit(" 12:00:00 AM"),
        ).alias("date_rptd"),
    )
