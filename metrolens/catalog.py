"""Query catalogue: every operator of the survey as a runnable query over the
driver tables, with the DuckDB SQL that computes the same rows.

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame. Builders for
sources first write their input (derived from the driver tables) under the
shared checkpoint folder and then read it back; all other builders are lazy.
The SQL strings define the same derived views as CTEs (FIXTURES.md section 3).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metrolens.functions import (
    MONTH_ABBREVIATIONS,
    TIME_OF_DAY_BANDS,
    TIME_OF_DAY_DEFAULT,
    cast_columns,
    date_parts,
    haversine_km,
    haversine_km_udf,
    parse_currency,
    time_of_day,
    time_of_day_udf,
)
from metrolens.operators import (
    assign_nearest,
    bucket_diff,
    conditional_count,
    diff_tables,
    exact_stats,
    except_distinct,
    global_count,
    group_avg,
    group_count,
    group_count_sql,
    group_sum,
    hinted_join,
    limit_n,
    nearest_join,
    rank_all,
    register_view,
    ratio_join,
    share_by,
    skew_join,
    topk_per_group,
    topk_sql,
    union_all,
    with_position,
)
from metrolens.plans import api_report, conversion_report, format_report, strategy_report
from metrolens.session import staging_path
from metrolens.sources import (
    blocks,
    column_at,
    incidents,
    income,
    number_lines,
    orders_text,
    profile,
    profile_geojson,
    read_csv,
    read_delimited,
    read_geojson,
    read_range,
    read_table,
    read_text,
    sample_lines,
    sites,
    split_fields,
    write_clustered,
    write_csv,
    write_geojson,
    write_text,
)
from metrolens.sources.parquet import convert_csv_to_parquet

Builder = Callable[[SparkSession, str], DataFrame]

# The reference point for the distance queries (central Los Angeles).
REF_LAT, REF_LON = 34.0537, -118.2428
# The date that splits orders into two source files, like the
# reference's two incident files (2010-2019 and 2020-2025).
SPLIT_DATE = "1998-01-01"
TOP_K = 3
LIMIT_N = 10

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
ORDERS_SCHEMA = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string"
)
INCIDENT_SCHEMA = "event_id bigint, time_occ int, premis_desc string, crime_lat double, crime_lon double"


# ---------------------------------------------------------------- shared pieces

def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders", ORDER_COLUMNS)


def _before_split(c: str = "o_orderdate") -> Column:
    return F.col(c) < F.lit(SPLIT_DATE).cast("timestamp_ntz")


def _order_halves(spark: SparkSession, sf_dir: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    o = _orders(spark, sf_dir)
    early = o.filter(_before_split()).select(*columns)
    late = o.filter(~_before_split() | F.col("o_orderdate").isNull()).select(*columns)
    return early, late


def _street(df: DataFrame) -> Column:
    return F.col("premis_desc") == "STREET"


def street_share(df: DataFrame, null_policy: str = "default") -> DataFrame:
    """C1: share of STREET incidents per time of day, descending."""
    return share_by(
        df, time_of_day("time_occ", null_policy), _street(df), "time_of_day", "street_pct", null_policy
    ).orderBy(F.col("street_pct").desc(), F.col("time_of_day"))


def street_share_udf(df: DataFrame) -> DataFrame:
    """C1 with the Arrow-batched UDF (a NULL time is its own group)."""
    keyed = df.select(time_of_day_udf("time_occ").alias("time_of_day"), "premis_desc")
    return share_by(keyed, F.col("time_of_day"), _street(keyed), "time_of_day", "street_pct", "group").orderBy(
        F.col("street_pct").desc(), F.col("time_of_day")
    )


def street_share_sql(spark: SparkSession, df: DataFrame) -> DataFrame:
    """C1 written as SQL over ``df``."""
    cases = " ".join(f"WHEN time_occ BETWEEN {lo} AND {hi} THEN '{label}'" for lo, hi, label in TIME_OF_DAY_BANDS)
    return spark.sql(
        f"""
        SELECT time_of_day,
               ROUND(try_divide(count_if(premis_desc = 'STREET'), COUNT(*)) * 100.0, 2) AS street_pct
        FROM (SELECT CASE {cases} ELSE '{TIME_OF_DAY_DEFAULT}' END AS time_of_day, premis_desc FROM {{src}})
        GROUP BY time_of_day
        ORDER BY street_pct DESC, time_of_day
        """,
        src=df,
    )


def month_parts(spark: SparkSession, sf_dir: str, mode: str = "slice") -> DataFrame:
    year, month = date_parts("date_rptd", mode=mode)
    return orders_text(spark, sf_dir).select("o_orderkey", year.alias("year"), month.alias("month"))


def month_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = month_parts(spark, sf_dir)
    return parts.groupBy(F.col("year"), F.col("month")).count().withColumnRenamed("count", "crime_total")


def c2_order() -> list[Column]:
    """Total order of the C2 result: year, count descending, rank, month."""
    return [F.col("year").asc(), F.col("crime_total").desc(), F.col("ranking").asc(), F.col("month").asc()]


def top_months(spark: SparkSession, sf_dir: str, ties: str = "rank") -> DataFrame:
    """C2: top 3 months per year by count (rank keeps ties)."""
    order = [F.col("crime_total").desc()] + ([F.col("month").asc()] if ties == "row_number" else [])
    return topk_per_group(month_counts(spark, sf_dir), ["year"], order, TOP_K, ties).orderBy(*c2_order())


def census_by_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population per ZIP over blocks with a truthy ZIP and population."""
    b = blocks(spark, sf_dir)
    truthy = F.col("zcta").isNotNull() & (F.col("zcta") != "") & F.col("pop").isNotNull() & (F.col("pop") != 0)
    return group_sum(b.filter(truthy), [F.col("zcta").alias("zipcode")], "pop", "total_population")


def income_lenient(spark: SparkSession, sf_dir: str, raw: bool = False) -> DataFrame:
    """Income per ZIP as a number; with ``raw`` also as the text it came as."""
    inc = income(spark, sf_dir).filter(F.col("zip_code").isNotNull() & F.col("median_income_raw").isNotNull())
    text = [F.col("median_income_raw")] if raw else []
    return inc.select(F.col("zip_code").alias("zipcode"), parse_currency("median_income_raw").alias("median_income"), *text)


def income_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    inc = income(spark, sf_dir).select(
        F.regexp_replace("zip_code", r"^\s+|\s+$", "").alias("zipcode"),
        parse_currency("median_income_raw", strict=True).alias("median_income"),
    )
    return inc.filter(F.col("median_income").isNotNull() & F.col("zipcode").isNotNull())


def per_capita(spark: SparkSession, sf_dir: str, strategy: str = "DEFAULT", raw: bool = False) -> DataFrame:
    """C3: median income / population per ZIP, rounded to 2 places."""
    return ratio_join(
        census_by_zip(spark, sf_dir),
        income_lenient(spark, sf_dir, raw),
        "zipcode",
        "median_income",
        "total_population",
        "per_capita_income_2020_2021",
        decimals=2,
        strategy=strategy,
    ).orderBy("zipcode")


def nearest_division(
    spark: SparkSession, sf_dir: str, unit: str = "location", strategy: str = "DEFAULT"
) -> DataFrame:
    """C4: each incident point to its nearest station; count and mean km per division."""
    return nearest_join(
        incidents(spark, sf_dir),
        sites(spark, sf_dir),
        "crime_lat",
        "crime_lon",
        "division",
        "station_lat",
        "station_lon",
        unit=unit,
        strategy=strategy,
    ).orderBy(F.col("crime_count").desc(), F.col("division"))


# ---------------------------------------------------------------- builders

def q_project_cast(spark, sf_dir):
    inc = incidents(spark, sf_dir).select(
        "event_id",
        F.lpad(F.col("time_occ").cast("string"), 4, "0").alias("time_text"),
        "premis_desc",
        "crime_lat",
        "crime_lon",
    )
    return cast_columns(
        inc,
        {
            "event_id": ("event_id", None),
            "time_occ": ("time_text", "int"),
            "premis_desc": ("premis_desc", "string"),
            "crime_lat": ("crime_lat", "double"),
            "crime_lon": ("crime_lon", "double"),
        },
    )


def q_filter_not_null(spark, sf_dir):
    return (
        incidents(spark, sf_dir)
        .dropna(subset=["crime_lat", "crime_lon"])
        .select("event_id", "crime_lat", "crime_lon")
    )


def q_bucket_range(spark, sf_dir):
    return incidents(spark, sf_dir).select("event_id", "time_occ", time_of_day("time_occ").alias("time_of_day"))


def q_bucket_udf(spark, sf_dir):
    return incidents(spark, sf_dir).select("event_id", "time_occ", time_of_day_udf("time_occ").alias("time_of_day"))


def q_conditional_count(spark, sf_dir):
    inc = incidents(spark, sf_dir)
    return conditional_count(inc, [time_of_day("time_occ").alias("time_of_day")], _street(inc), "street", "total")


def q_group_count(spark, sf_dir):
    inc = incidents(spark, sf_dir)
    return group_count(inc, [time_of_day("time_occ").alias("time_of_day"), F.col("premis_desc")], "crime_total")


def q_global_count(spark, sf_dir):
    return global_count(incidents(spark, sf_dir), "row_count")


def q_share_by_bucket(spark, sf_dir):
    return street_share(incidents(spark, sf_dir), "default")


def q_share_by_bucket_drop(spark, sf_dir):
    return street_share(incidents(spark, sf_dir), "drop")


def q_share_by_bucket_group(spark, sf_dir):
    return street_share(incidents(spark, sf_dir), "group")


def q_share_by_bucket_udf(spark, sf_dir):
    return street_share_udf(incidents(spark, sf_dir))


def q_share_by_bucket_sql(spark, sf_dir):
    return street_share_sql(spark, incidents(spark, sf_dir))


def q_group_sum(spark, sf_dir):
    return census_by_zip(spark, sf_dir)


def q_group_avg(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", ["l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice"])
    return group_avg(
        li,
        ["l_returnflag", "l_linestatus"],
        {"avg_qty": "l_quantity", "avg_price": "l_extendedprice"},
        decimals=3,
        count_name="count_order",
    )


def q_date_parts(spark, sf_dir):
    return month_parts(spark, sf_dir)


def q_date_parts_parsed(spark, sf_dir):
    return month_parts(spark, sf_dir, "parse")


def q_topk_rank(spark, sf_dir):
    return top_months(spark, sf_dir, "rank")


def q_topk_row_number(spark, sf_dir):
    return top_months(spark, sf_dir, "row_number")


def _top_months_sql(spark, source) -> DataFrame:
    """C2 through SQL; the source's own column names hold spaces."""
    counted = group_count_sql(spark, source, ["Crime Year", "Crime Month"], "crime_total")
    top = topk_sql(spark, counted, ["Crime Year"], [("crime_total", "DESC")], TOP_K)
    return top.toDF("year", "month", "crime_total", "ranking").orderBy(*c2_order())


def _named_months(spark, sf_dir) -> DataFrame:
    return month_parts(spark, sf_dir).select(F.col("year").alias("Crime Year"), F.col("month").alias("Crime Month"))


def q_sql_topk(spark, sf_dir):
    return _top_months_sql(spark, _named_months(spark, sf_dir))


def q_sql_topk_view(spark, sf_dir):
    """C2 through SQL over a registered view."""
    register_view(_named_months(spark, sf_dir), "dated_incidents")
    return _top_months_sql(spark, "dated_incidents")


def q_sort_position(spark, sf_dir):
    return with_position(top_months(spark, sf_dir, "rank"), c2_order(), "pos")


def q_limit_n(spark, sf_dir):
    o = _orders(spark, sf_dir).select("o_orderkey", "o_totalprice")
    return limit_n(o, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], LIMIT_N, "pos")


def q_union_all(spark, sf_dir):
    early, late = _order_halves(spark, sf_dir, ORDER_COLUMNS)
    return union_all([early, late])


def q_except_distinct(spark, sf_dir):
    early, late = _order_halves(spark, sf_dir, ["o_custkey", "o_orderpriority"])
    return except_distinct(early, late)


def q_diff_tables(spark, sf_dir):
    early, late = _order_halves(spark, sf_dir, ["o_custkey", "o_orderpriority"])
    return diff_tables(early, late)


def q_bucket_diff(spark, sf_dir):
    """Orders against a later state of them: some changed, some gone, some twice."""
    now = _orders(spark, sf_dir)
    key = F.col("o_orderkey")
    later = now.filter(key % 101 != 0).withColumn(
        "o_totalprice", F.when(key % 97 == 0, F.col("o_totalprice") + 1.0).otherwise(F.col("o_totalprice"))
    )
    return bucket_diff(now, later.unionAll(now.filter(key % 89 == 0)))


def q_skewed_join(spark, sf_dir):
    """Orders and suppliers by a key that a third of both share: pairs per key."""
    key = lambda c, of: F.when(F.col(c) % 3 == 0, F.lit(0)).otherwise(F.col(of) % 50 + 1).alias("key")
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    suppliers = read_table(spark, sf_dir, "supplier", ["s_suppkey"])
    pairs = skew_join(
        orders.select("o_orderkey", key("o_orderkey", "o_custkey")),
        suppliers.select("s_suppkey", key("s_suppkey", "s_suppkey")),
        ["key"],
    )
    return pairs.groupBy("key").agg(
        F.count(F.lit(1)).alias("pairs"),
        F.sum("o_orderkey").alias("orders"),
        F.sum(F.col("o_orderkey") % 7 * F.col("s_suppkey")).alias("mixed"),
    )


def q_rank_all(spark, sf_dir):
    """All orders ranked by date within groups of which one holds a third of them."""
    grp = F.when(F.col("o_orderkey") % 3 == 0, F.lit("hot")).otherwise(F.col("o_orderpriority")).alias("grp")
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate", "o_orderpriority"])
    dated = orders.select("o_orderkey", grp, F.to_date("o_orderdate").alias("day"))
    ranked = rank_all(dated, ["grp"], [("day", "DESC")])
    return ranked.select("o_orderkey", "grp", "rank", "dense_rank")


def q_line_numbers(spark, sf_dir):
    """Lines of several files with their place in all of them, less the first ten."""
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"]).orderBy("o_orderkey")
    path = write_text(orders.select(F.concat_ws(";", "o_orderkey", "o_custkey")), staging_path(spark, "numbered"))
    return number_lines(spark, path, skip=10)


def q_clustered_scan(spark, sf_dir):
    """Orders clustered on customer and price, read back by a range of both."""
    path = write_clustered(
        _orders(spark, sf_dir), staging_path(spark, "clustered"), ["o_custkey", "o_totalprice"], file_bytes=64 << 10
    )
    return read_range(spark, path, {"o_custkey": (100, 400), "o_totalprice": (50_000.0, 250_000.0)})


def q_exact_avg(spark, sf_dir):
    """Sums and means of doubles that are the same for every partitioning."""
    items = read_table(spark, sf_dir, "lineitem", ["l_returnflag", "l_extendedprice", "l_discount"])
    net = items.select("l_returnflag", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"))
    found = exact_stats(net, ["l_returnflag"], "net")
    return found.select("l_returnflag", "n", F.round("sum", 2).alias("sum_net"), F.round("avg", 4).alias("avg_net"))


def q_currency_lenient(spark, sf_dir):
    inc = income(spark, sf_dir)
    return inc.select("zip_code", parse_currency("median_income_raw").alias("median_income"))


def q_currency_strict(spark, sf_dir):
    return income_strict(spark, sf_dir).withColumnRenamed("zipcode", "zip_code")


def _join_with(strategy: str) -> Builder:
    def build(spark, sf_dir):
        return hinted_join(census_by_zip(spark, sf_dir), income_lenient(spark, sf_dir), "zipcode", "inner", strategy)

    return build


def q_ratio_join(spark, sf_dir):
    return per_capita(spark, sf_dir)


def q_ratio_join_strict(spark, sf_dir):
    return ratio_join(
        census_by_zip(spark, sf_dir),
        income_strict(spark, sf_dir),
        "zipcode",
        "median_income",
        "total_population",
        "per_capita_income",
        decimals=None,
    ).orderBy("zipcode")


def q_ratio_join_raw(spark, sf_dir):
    """C3 with the income as its text beside the number."""
    return per_capita(spark, sf_dir, raw=True)


def per_capita_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C3 written as SQL over the block and income tables."""
    return spark.sql(
        """
        SELECT zipcode, total_population, median_income,
               ROUND(try_divide(median_income, CAST(total_population AS DOUBLE)), 2) AS per_capita_income_2020_2021
        FROM (SELECT zcta AS zipcode, SUM(pop) AS total_population FROM {census}
              WHERE zcta <> '' AND pop <> 0 GROUP BY zcta)
        JOIN (SELECT zip_code AS zipcode,
                     try_cast(regexp_replace(median_income_raw, '[$,]', '') AS DOUBLE) AS median_income
              FROM {money} WHERE median_income_raw IS NOT NULL) USING (zipcode)
        ORDER BY zipcode
        """,
        census=blocks(spark, sf_dir),
        money=income(spark, sf_dir),
    )


def q_ratio_join_sql(spark, sf_dir):
    return per_capita_sql(spark, sf_dir)


def _distance_points(spark, sf_dir) -> DataFrame:
    """Incident points, some with NULL coordinates and some that are no number."""
    broken = F.when(F.col("event_id") % 103 == 0, F.lit(float("nan"))).otherwise(F.col("crime_lat"))
    return incidents(spark, sf_dir).select("event_id", broken.alias("crime_lat"), "crime_lon")


def _shown_km(km: Column) -> Column:
    """Rounded, with NaN told apart from NULL in a text column."""
    return F.when(F.isnan(km), F.lit("not a number")).when(km.isNull(), F.lit("missing")).otherwise(F.lit("ok"))


def _distances(points: DataFrame, distance) -> DataFrame:
    km = distance("crime_lat", "crime_lon", F.lit(REF_LAT), F.lit(REF_LON))
    kept = points.select("event_id", km.alias("km"))
    finite = F.when(F.isnan("km"), F.lit(None).cast("double")).otherwise(F.round("km", 3))
    return kept.select("event_id", finite.alias("km"), _shown_km(F.col("km")).alias("state"))


def q_haversine(spark, sf_dir):
    return _distances(_distance_points(spark, sf_dir), haversine_km)


def q_haversine_udf(spark, sf_dir):
    return _distances(_distance_points(spark, sf_dir), haversine_km_udf)


def q_nearest_per_location(spark, sf_dir):
    return nearest_division(spark, sf_dir, "location")


def q_nearest_per_event(spark, sf_dir):
    return nearest_division(spark, sf_dir, "event")


def _customer_spots(spark, sf_dir, step: float) -> DataFrame:
    """Customers as sites, ``step`` degrees apart from one corner."""
    key = F.col("c_custkey")
    return read_table(spark, sf_dir, "customer", ["c_custkey"]).select(
        key.alias("site"),
        (F.lit(34.05) + (key % 31).cast("double") * F.lit(step)).alias("site_lat"),
        (F.lit(-118.25) + (key % 37).cast("double") * F.lit(step)).alias("site_lon"),
    )


def _order_places(spark, sf_dir, west: float) -> DataFrame:
    """Places all over the globe from order keys, longitudes from ``west`` on."""
    key = F.col("o_orderkey")
    return read_table(spark, sf_dir, "orders", ["o_orderkey"]).select(
        (F.lit(-89.5) + (key % 359).cast("double") / F.lit(2.0)).alias("lat"),
        (F.lit(west) + (key * 7 % 719).cast("double") / F.lit(2.0)).alias("lon"),
    )


def _nearest_km(points: DataFrame, sites_df: DataFrame) -> DataFrame:
    found = assign_nearest(points, sites_df, "lat", "lon", "site", "site_lat", "site_lon")
    return found.select("lat", "lon", "n", F.round("km", 4).alias("km"))


def q_nearest_far(spark, sf_dir):
    """Places all over the globe, sites crowded into one city."""
    return _nearest_km(_order_places(spark, sf_dir, -179.75), _customer_spots(spark, sf_dir, 0.01))


def q_nearest_dense(spark, sf_dir):
    """All sites within a hundred metres, incidents around them."""
    near = incidents(spark, sf_dir).select(F.col("crime_lat").alias("lat"), F.col("crime_lon").alias("lon"))
    return _nearest_km(near, _customer_spots(spark, sf_dir, 0.00003))


def q_nearest_wide_longitudes(spark, sf_dir):
    """Longitudes written from 0 to 360, sites all over the globe."""
    key = F.col("s_suppkey")
    spots = read_table(spark, sf_dir, "supplier", ["s_suppkey"]).select(
        key.alias("site"),
        (F.lit(-88.25) + (key * 13 % 353).cast("double") / F.lit(2.0)).alias("site_lat"),
        (F.lit(0.25) + (key * 29 % 719).cast("double") / F.lit(2.0)).alias("site_lon"),
    )
    return _nearest_km(_order_places(spark, sf_dir, 0.0), spots)


def _write_order_csvs(spark, sf_dir) -> list[str]:
    base = staging_path(spark, "orders-csv")
    early, late = _order_halves(spark, sf_dir, ORDER_COLUMNS)
    return [write_csv(early, f"{base}/early"), write_csv(late, f"{base}/late")]


def q_csv_scan(spark, sf_dir):
    paths = _write_order_csvs(spark, sf_dir)
    return union_all([read_csv(spark, p, schema=ORDERS_SCHEMA) for p in paths])


def _write_income_file(spark, sf_dir) -> str:
    path = staging_path(spark, "income-delimited")
    named = income(spark, sf_dir).toDF("Zip Code", "Community", "Estimated Median Income")
    return write_csv(named, path, sep=";")


def q_delimited_scan(spark, sf_dir):
    raw = read_delimited(spark, _write_income_file(spark, sf_dir), 3, sep=";")
    return raw.select(F.col(column_at(raw, 0)).alias("zip_code"), F.col(column_at(raw, 2)).alias("median_income_raw"))


def q_text_scan(spark, sf_dir):
    path = write_text(orders_text(spark, sf_dir).select("date_rptd"), staging_path(spark, "orders-text"))
    return read_text(spark, path)


def q_split_fields(spark, sf_dir):
    """The income file with a control character inside every fourth name."""
    name = F.when(F.col("zip_code").endswith("4"), F.concat("community", F.lit("\u0001x"))).otherwise(F.col("community"))
    odd = income(spark, sf_dir).select("zip_code", name.alias("community"), "median_income_raw")
    named = odd.toDF("Zip Code", "Community", "Estimated Median Income")
    path = write_csv(named, staging_path(spark, "income-text"), sep=";")
    return split_fields(spark, path, sep=";", min_fields=3, keep=[0, 2], names=["zip_code", "median_income_raw"])


def q_sample_lines(spark, sf_dir):
    """A look at a small file: its lines, cut to 12 characters."""
    names = income(spark, sf_dir).select(F.concat_ws(" ", "zip_code", "community"))
    return sample_lines(spark, write_text(names, staging_path(spark, "income-lines")), n=1000, width=12)


def _write_blocks(spark, sf_dir, layout: str) -> str:
    b = blocks(spark, sf_dir)
    # Some ZIPs as JSON numbers, as in the source: a VARIANT keeps each value's own type.
    number = (F.col("pop") % 2 == 1) & F.col("zcta").isNotNull()
    zcta = F.when(number, F.col("zcta").cast("bigint").cast("variant")).otherwise(F.col("zcta").cast("variant"))
    properties = b.select(zcta.alias("ZCTA20"), F.col("pop").alias("POP20"))
    return write_geojson(properties, staging_path(spark, f"blocks-{layout}"), layout)


def q_geojson_features(spark, sf_dir):
    return read_geojson(spark, _write_blocks(spark, sf_dir, "lines"), layout="lines")


def q_geojson_document(spark, sf_dir):
    return read_geojson(spark, _write_blocks(spark, sf_dir, "pretty"), layout="document")


def q_geojson_split(spark, sf_dir):
    """A pretty-printed document read as text across tasks (large single documents)."""
    return read_geojson(spark, _write_blocks(spark, sf_dir, "pretty"), layout="split")


def q_geojson_oneline(spark, sf_dir):
    """The usual export form, a whole document on one line, cut at bytes across tasks."""
    return read_geojson(spark, _write_blocks(spark, sf_dir, "oneline"), layout="split")


def q_geojson_profile(spark, sf_dir):
    return profile_geojson(spark, _write_blocks(spark, sf_dir, "lines"), layout="lines")


def q_parquet_roundtrip(spark, sf_dir):
    return convert_csv_to_parquet(
        spark, _write_order_csvs(spark, sf_dir), ORDERS_SCHEMA, staging_path(spark, "orders-parquet"),
        partition_by=["o_orderstatus"],
    )


def q_profile(spark, sf_dir):
    return profile(_orders(spark, sf_dir))


def _write_incident_csvs(spark, sf_dir) -> list[str]:
    """Incidents as two CSV files with the source's own column names (spaces included),
    split at the median event id, like the source's two reporting periods. Every row is kept."""
    base = staging_path(spark, "incidents-csv")
    inc = incidents(spark, sf_dir).toDF("EVENT ID", "TIME OCC", "Premis Desc", "LAT", "LON")
    middle = F.lit(_median_event_id(spark, sf_dir))
    first = inc.filter(F.col("EVENT ID") < middle)
    second = inc.filter(~(F.col("EVENT ID") < middle) | F.col("EVENT ID").isNull())
    return [write_csv(first, f"{base}/first"), write_csv(second, f"{base}/second")]


def _median_event_id(spark, sf_dir) -> int:
    # One-row aggregate: the split point between the two incident files.
    row = read_table(spark, sf_dir, "events", ["event_id"]).agg(
        F.percentile_approx("event_id", 0.5).alias("m")
    ).first()
    return int(row.m or 0)


def q_share_by_bucket_csv(spark, sf_dir):
    """C1 end to end from two CSV files: declared text schema, ANSI-safe cast, union, share."""
    raw_schema = "`EVENT ID` string, `TIME OCC` string, `Premis Desc` string, LAT string, LON string"
    parts = [read_csv(spark, p, schema=raw_schema) for p in _write_incident_csvs(spark, sf_dir)]
    crimes = cast_columns(
        union_all(parts), {"time_occ": ("TIME OCC", "int"), "premis_desc": ("Premis Desc", None)}
    )
    return street_share(crimes)


def q_ratio_join_geojson(spark, sf_dir):
    """C3 end to end: census blocks from GeoJSON, population per ZIP, joined to income."""
    blocks_path = _write_blocks(spark, sf_dir, "lines")
    census = group_sum(read_geojson(spark, blocks_path, layout="lines"), ["zipcode"], "population", "total_population")
    return ratio_join(
        census, income_lenient(spark, sf_dir), "zipcode", "median_income", "total_population",
        "per_capita_income_2020_2021", decimals=2,
    ).orderBy("zipcode")


def q_nearest_csv_sites(spark, sf_dir):
    """C4 with stations from a CSV whose X column is the longitude and Y the latitude."""
    path = staging_path(spark, "stations-csv")
    write_csv(sites(spark, sf_dir).select(
        F.col("division").alias("DIVISION"), F.col("station_lon").alias("X"), F.col("station_lat").alias("Y")
    ), path)
    stations = read_csv(spark, path, schema="DIVISION string, X double, Y double")
    return nearest_join(
        incidents(spark, sf_dir), stations, "crime_lat", "crime_lon", "DIVISION", "Y", "X", unit="location"
    ).orderBy(F.col("crime_count").desc(), F.col("division"))


def q_union_by_position(spark, sf_dir):
    early, late = _order_halves(spark, sf_dir, ORDER_COLUMNS)
    return union_all([early, late], by_position=True)


REPORT_STRATEGIES = ["DEFAULT", "broadcast", "merge", "shuffle_hash"]


def timed_strategies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C3 under each join strategy, timed."""
    census, money = census_by_zip(spark, sf_dir), income_lenient(spark, sf_dir)

    def build(strategy):
        return ratio_join(
            census, money, "zipcode", "median_income", "total_population", "per_capita_income_2020_2021", 2, strategy
        )

    return strategy_report(spark, build, REPORT_STRATEGIES, cache=[census, money])


def timed_nearest_strategies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4 under each join strategy, timed."""
    return strategy_report(
        spark, lambda strategy: nearest_division(spark, sf_dir, "location", strategy), REPORT_STRATEGIES
    )


def _write_incident_sources(spark, sf_dir) -> tuple[str, str]:
    inc = incidents(spark, sf_dir)
    csv_path = write_csv(inc, staging_path(spark, "incidents-csv"))
    parquet_path = staging_path(spark, "incidents-parquet")
    inc.write.mode("overwrite").parquet(parquet_path)
    return csv_path, parquet_path


def timed_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 over CSV and Parquet, timed."""
    csv_path, parquet_path = _write_incident_sources(spark, sf_dir)
    return format_report(
        spark,
        {
            "parquet": lambda: street_share(spark.read.parquet(parquet_path)),
            "csv": lambda: street_share(read_csv(spark, csv_path, schema=INCIDENT_SCHEMA)),
            "csv_inferred": lambda: street_share(read_csv(spark, csv_path, infer_schema=True)),
        },
    )


def timed_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversion job: two incident CSV files -> one Parquet table with clean column names."""
    paths = _write_incident_csvs(spark, sf_dir)
    raw_schema = "`EVENT ID` bigint, `TIME OCC` int, `Premis Desc` string, LAT double, LON double"
    return conversion_report(
        spark,
        lambda: convert_csv_to_parquet(
            spark, paths, raw_schema, staging_path(spark, "incidents-parquet"), normalize_names=True
        ),
    )


def timed_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 (over known times, as its forms name a NULL time differently), C2 and C3 in their API forms, timed."""
    inc = incidents(spark, sf_dir).filter(F.col("time_occ").isNotNull())
    return api_report(
        spark,
        {
            "C1": {
                "expression": lambda: street_share(inc),
                "pandas_udf": lambda: street_share_udf(inc),
                "sql": lambda: street_share_sql(spark, inc),
            },
            "C2": {
                "dataframe": lambda: top_months(spark, sf_dir),
                "sql": lambda: q_sql_topk(spark, sf_dir),
                "sql_view": lambda: q_sql_topk_view(spark, sf_dir),
            },
            "C3": {
                "dataframe": lambda: per_capita(spark, sf_dir),
                "sql": lambda: per_capita_sql(spark, sf_dir).select(*per_capita(spark, sf_dir).columns),
            },
        },
    )


def _strategies_shown(report: DataFrame, *more: str) -> DataFrame:
    """What does not vary between runs; DEFAULT's join is the planner's choice."""
    node = F.when(F.col("strategy") != "DEFAULT", F.col("join_node"))
    return report.select("strategy", node.alias("join_node"), "rows", "same", *more)


def q_strategy_report(spark, sf_dir):
    return _strategies_shown(timed_strategies(spark, sf_dir), "join_rows")


def q_nearest_strategy_report(spark, sf_dir):
    return _strategies_shown(timed_nearest_strategies(spark, sf_dir))


def q_format_report(spark, sf_dir):
    return timed_formats(spark, sf_dir).select("format", "rows", "same")


def q_conversion_report(spark, sf_dir):
    return timed_conversion(spark, sf_dir).select("job", "rows", "columns")


def q_api_report(spark, sf_dir):
    return timed_forms(spark, sf_dir).select("query", "api", "rows", "same")


QUERIES: dict[str, Builder] = {
    "project_cast": q_project_cast,
    "filter_not_null": q_filter_not_null,
    "bucket_range": q_bucket_range,
    "bucket_udf": q_bucket_udf,
    "conditional_count": q_conditional_count,
    "group_count": q_group_count,
    "global_count": q_global_count,
    "share_by_bucket": q_share_by_bucket,
    "share_by_bucket_drop": q_share_by_bucket_drop,
    "share_by_bucket_group": q_share_by_bucket_group,
    "share_by_bucket_udf": q_share_by_bucket_udf,
    "share_by_bucket_sql": q_share_by_bucket_sql,
    "group_sum": q_group_sum,
    "group_avg": q_group_avg,
    "date_parts": q_date_parts,
    "date_parts_parsed": q_date_parts_parsed,
    "topk_rank": q_topk_rank,
    "topk_row_number": q_topk_row_number,
    "sql_topk": q_sql_topk,
    "sql_topk_view": q_sql_topk_view,
    "sort_position": q_sort_position,
    "limit_n": q_limit_n,
    "union_all": q_union_all,
    "except_distinct": q_except_distinct,
    "diff_tables": q_diff_tables,
    "bucket_diff": q_bucket_diff,
    "skewed_join": q_skewed_join,
    "rank_all": q_rank_all,
    "line_numbers": q_line_numbers,
    "clustered_scan": q_clustered_scan,
    "exact_avg": q_exact_avg,
    "currency_lenient": q_currency_lenient,
    "currency_strict": q_currency_strict,
    "inner_join": _join_with("DEFAULT"),
    "join_broadcast": _join_with("broadcast"),
    "join_merge": _join_with("merge"),
    "join_shuffle_hash": _join_with("shuffle_hash"),
    "ratio_join": q_ratio_join,
    "ratio_join_strict": q_ratio_join_strict,
    "haversine": q_haversine,
    "haversine_udf": q_haversine_udf,
    "nearest_per_location": q_nearest_per_location,
    "nearest_per_event": q_nearest_per_event,
    "csv_scan": q_csv_scan,
    "delimited_scan": q_delimited_scan,
    "text_scan": q_text_scan,
    "split_fields": q_split_fields,
    "geojson_features": q_geojson_features,
    "geojson_document": q_geojson_document,
    "geojson_split": q_geojson_split,
    "geojson_oneline": q_geojson_oneline,
    "geojson_profile": q_geojson_profile,
    "parquet_roundtrip": q_parquet_roundtrip,
    "share_by_bucket_csv": q_share_by_bucket_csv,
    "ratio_join_geojson": q_ratio_join_geojson,
    "nearest_csv_sites": q_nearest_csv_sites,
    "nearest_far": q_nearest_far,
    "nearest_dense": q_nearest_dense,
    "nearest_wide_longitudes": q_nearest_wide_longitudes,
    "sample_lines": q_sample_lines,
    "ratio_join_raw": q_ratio_join_raw,
    "ratio_join_sql": q_ratio_join_sql,
    "union_by_position": q_union_by_position,
    "profile": q_profile,
    "strategy_report": q_strategy_report,
    "nearest_strategy_report": q_nearest_strategy_report,
    "format_report": q_format_report,
    "api_report": q_api_report,
    "conversion_report": q_conversion_report,
}


# ---------------------------------------------------------------- DuckDB oracle SQL

_VIEWS = """
incidents AS (
    SELECT event_id,
           CASE WHEN event_id % 97 = 0 THEN NULL
                ELSE CAST(hour(ts) * 100 + minute(ts) AS INTEGER) END AS time_occ,
           CASE WHEN event_type = 'error' THEN 'STREET' ELSE upper(event_type) END AS premis_desc,
           CASE WHEN event_id % 101 = 0 THEN NULL
                ELSE CAST(33.7 AS DOUBLE) + CAST(event_id % 700 AS DOUBLE) / CAST(1000 AS DOUBLE) END AS crime_lat,
           CAST(-118.6 AS DOUBLE) + CAST((event_id * 7) % 600 AS DOUBLE) / CAST(1000 AS DOUBLE) AS crime_lon
    FROM events
),
sites AS (
    SELECT n_name AS division,
           CAST(-118.6 AS DOUBLE) + CAST((n_nationkey * 37) % 25 AS DOUBLE) * CAST(0.024 AS DOUBLE) AS station_lon,
           CAST(33.7 AS DOUBLE) + CAST((n_nationkey * 11) % 25 AS DOUBLE) * CAST(0.028 AS DOUBLE) AS station_lat
    FROM nation
),
blocks AS (
    SELECT CASE WHEN c_custkey % 53 = 0 THEN NULL ELSE CAST(90000 + c_nationkey AS VARCHAR) END AS zcta,
           CASE WHEN c_custkey % 41 = 0 THEN CAST(0 AS BIGINT) ELSE CAST(c_custkey % 900 + 1 AS BIGINT) END AS pop
    FROM customer
),
income AS (
    SELECT CAST(90000 + n_nationkey AS VARCHAR) AS zip_code,
           n_name AS community,
           CASE WHEN n_nationkey % 6 = 0 THEN '---'
                WHEN n_nationkey % 7 = 3 THEN NULL
                ELSE concat('$', CAST(20 + n_nationkey * 3 AS VARCHAR), ',',
                            lpad(CAST((n_nationkey * 137) % 1000 AS VARCHAR), 3, '0')) END AS median_income_raw
    FROM nation
),
orders_text AS (
    SELECT o_orderkey,
           concat(CAST(year(o_orderdate) AS VARCHAR), ' ',
                  substring('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(month(o_orderdate) AS INTEGER) * 3 - 2, 3), ' ',
                  lpad(CAST(day(o_orderdate) AS VARCHAR), 2, '0'), ' 12:00:00 AM') AS date_rptd
    FROM orders
)"""


def _sql(body: str, *ctes: str) -> str:
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH {_VIEWS}{extra}\n{body}"


def _tod_sql(null_label: bool) -> str:
    arms = " ".join(f"WHEN time_occ BETWEEN {lo} AND {hi} THEN '{label}'" for lo, hi, label in TIME_OF_DAY_BANDS)
    head = "CASE WHEN time_occ IS NULL THEN NULL " if null_label else "CASE "
    return f"{head}{arms} ELSE '{TIME_OF_DAY_DEFAULT}' END"


_TOD = _tod_sql(False)
_TOD_NULL = _tod_sql(True)
_MONTH_CASE = (
    "CASE substring(date_rptd, 6, 3) "
    + " ".join(f"WHEN '{m}' THEN {i}" for i, m in enumerate(MONTH_ABBREVIATIONS, start=1))
    + " END"
)


def _hav_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    two = "CAST(2.0 AS DOUBLE)"
    s1 = f"sin((radians({lat2}) - radians({lat1})) / {two})"
    s2 = f"sin((radians({lon2}) - radians({lon1})) / {two})"
    raw = f"({s1} * {s1} + cos(radians({lat1})) * cos(radians({lat2})) * ({s2} * {s2}))"
    a = f"(CASE WHEN {raw} > 1.0 THEN CAST(1.0 AS DOUBLE) ELSE {raw} END)"
    return f"(CAST(6371.0 AS DOUBLE) * ({two} * atan2(sqrt({a}), sqrt(CAST(1.0 AS DOUBLE) - {a}))))"


def _share_sql(where: str, tod: str) -> str:
    return _sql(
        f"""SELECT time_of_day,
       ROUND(CAST(SUM(CASE WHEN premis_desc = 'STREET' THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) * 100.0, 2) AS street_pct
FROM (SELECT {tod} AS time_of_day, premis_desc FROM incidents {where}) t
GROUP BY time_of_day"""
    )


_PARTS = f"parts AS (SELECT o_orderkey, TRY_CAST(substring(date_rptd, 1, 4) AS INTEGER) AS year, {_MONTH_CASE} AS month FROM orders_text)"
_COUNTS = "counts AS (SELECT year, month, COUNT(*) AS crime_total FROM parts GROUP BY year, month)"
_RANKED = (
    "ranked AS (SELECT year, month, crime_total, "
    "CAST(RANK() OVER (PARTITION BY year ORDER BY crime_total DESC) AS INTEGER) AS ranking FROM counts)"
)
_TOPK = _sql(f"SELECT year, month, crime_total, ranking FROM ranked WHERE ranking <= {TOP_K}", _PARTS, _COUNTS, _RANKED)

_CENSUS = (
    "census AS (SELECT zcta AS zipcode, CAST(SUM(pop) AS BIGINT) AS total_population FROM blocks "
    "WHERE zcta IS NOT NULL AND zcta <> '' AND pop IS NOT NULL AND pop <> 0 GROUP BY zcta)"
)
_INCOME_LENIENT = (
    "inc AS (SELECT zip_code AS zipcode, "
    "TRY_CAST(regexp_replace(median_income_raw, '[$,]', '', 'g') AS DOUBLE) AS median_income "
    "FROM income WHERE zip_code IS NOT NULL AND median_income_raw IS NOT NULL)"
)
_STRICT_DIGITS = "translate(regexp_replace(median_income_raw, '^\\s+|\\s+$', '', 'g'), '$,', '')"
_INCOME_STRICT = (
    "inc_strict AS (SELECT regexp_replace(zip_code, '^\\s+|\\s+$', '', 'g') AS zipcode, "
    f"CAST({_STRICT_DIGITS} AS DOUBLE) AS median_income FROM income "
    f"WHERE median_income_raw IS NOT NULL AND regexp_matches({_STRICT_DIGITS}, '^[0-9]*\\.?[0-9]*$') "
    f"AND regexp_matches({_STRICT_DIGITS}, '[0-9]') AND zip_code IS NOT NULL)"
)
_JOIN = _sql(
    "SELECT c.zipcode, c.total_population, i.median_income FROM census c JOIN inc i ON c.zipcode = i.zipcode",
    _CENSUS,
    _INCOME_LENIENT,
)

_HALVES = (
    f"early AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{SPLIT_DATE} 00:00:00'), "
    f"late AS (SELECT * FROM orders WHERE NOT (o_orderdate < TIMESTAMP '{SPLIT_DATE} 00:00:00') OR o_orderdate IS NULL)"
)


def _nearest_sql(unit: str) -> str:
    dist = _hav_sql("p.crime_lat", "p.crime_lon", "s.station_lat", "s.station_lon")
    pts = (
        "pts AS (SELECT crime_lat, crime_lon, COUNT(*) AS n FROM incidents "
        "WHERE crime_lat IS NOT NULL AND crime_lon IS NOT NULL GROUP BY crime_lat, crime_lon)"
    )
    pairs = f"pairs AS (SELECT p.crime_lat, p.crime_lon, p.n, s.division, {dist} AS km FROM pts p CROSS JOIN sites s)"
    best = (
        "best AS (SELECT *, row_number() OVER (PARTITION BY crime_lat, crime_lon ORDER BY km, division) AS rn FROM pairs)"
    )
    if unit == "location":
        body = (
            "SELECT division, COUNT(*) AS crime_count, ROUND(AVG(km), 3) AS average_distance "
            "FROM best WHERE rn = 1 GROUP BY division"
        )
    else:
        body = (
            "SELECT division, CAST(SUM(n) AS BIGINT) AS crime_count, ROUND(SUM(km * n) / SUM(n), 3) AS average_distance "
            "FROM best WHERE rn = 1 GROUP BY division"
        )
    return _sql(body, pts, pairs, best)


_ORDERS_SELECT = "SELECT " + ", ".join(ORDER_COLUMNS) + " FROM orders"
_BLOCK_POINTS = (
    "SELECT zcta AS zipcode, pop AS population FROM blocks "
    "WHERE zcta IS NOT NULL AND zcta <> '' AND pop IS NOT NULL AND pop <> 0"
)
_PROFILE_TYPES = {
    "o_orderkey": "bigint",
    "o_custkey": "bigint",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz",
    "o_orderpriority": "string",
}

ORACLE_SQL: dict[str, str] = {
    "project_cast": _sql(
        "SELECT event_id, TRY_CAST(lpad(CAST(time_occ AS VARCHAR), 4, '0') AS INTEGER) AS time_occ, "
        "premis_desc, crime_lat, crime_lon FROM incidents"
    ),
    "filter_not_null": _sql(
        "SELECT event_id, crime_lat, crime_lon FROM incidents WHERE crime_lat IS NOT NULL AND crime_lon IS NOT NULL"
    ),
    "bucket_range": _sql(f"SELECT event_id, time_occ, {_TOD} AS time_of_day FROM incidents"),
    "bucket_udf": _sql(f"SELECT event_id, time_occ, {_TOD_NULL} AS time_of_day FROM incidents"),
    "conditional_count": _sql(
        f"SELECT {_TOD} AS time_of_day, CAST(SUM(CASE WHEN premis_desc = 'STREET' THEN 1 ELSE 0 END) AS BIGINT) AS street, "
        "COUNT(*) AS total FROM incidents GROUP BY 1"
    ),
    "group_count": _sql(
        f"SELECT {_TOD} AS time_of_day, premis_desc, COUNT(*) AS crime_total FROM incidents GROUP BY 1, 2"
    ),
    "global_count": _sql("SELECT COUNT(*) AS row_count FROM incidents"),
    "share_by_bucket": _share_sql("", _TOD),
    "share_by_bucket_drop": _share_sql("WHERE time_occ IS NOT NULL", _TOD),
    "share_by_bucket_group": _share_sql("", _TOD_NULL),
    "share_by_bucket_udf": _share_sql("", _TOD_NULL),
    "share_by_bucket_sql": _share_sql("", _TOD),
    "group_sum": _sql("SELECT zipcode, total_population FROM census", _CENSUS),
    "group_avg": (
        "SELECT l_returnflag, l_linestatus, ROUND(AVG(l_quantity), 3) AS avg_qty, "
        "ROUND(AVG(l_extendedprice), 3) AS avg_price, COUNT(*) AS count_order "
        "FROM lineitem GROUP BY l_returnflag, l_linestatus"
    ),
    "date_parts": _sql("SELECT o_orderkey, year, month FROM parts", _PARTS),
    "topk_rank": _TOPK,
    "topk_row_number": _sql(
        f"SELECT year, month, crime_total, ranking FROM rn WHERE ranking <= {TOP_K}",
        _PARTS,
        _COUNTS,
        "rn AS (SELECT year, month, crime_total, CAST(ROW_NUMBER() OVER (PARTITION BY year "
        "ORDER BY crime_total DESC, month ASC NULLS FIRST) AS INTEGER) AS ranking FROM counts)",
    ),
    "sql_topk": _TOPK,
    "sort_position": _sql(
        "SELECT year, month, crime_total, ranking, "
        "CAST(ROW_NUMBER() OVER (ORDER BY year ASC NULLS FIRST, crime_total DESC, ranking ASC, month ASC NULLS FIRST) AS BIGINT) AS pos "
        f"FROM ranked WHERE ranking <= {TOP_K}",
        _PARTS,
        _COUNTS,
        _RANKED,
    ),
    "limit_n": (
        "SELECT o_orderkey, o_totalprice, CAST(ROW_NUMBER() OVER (ORDER BY o_totalprice DESC, o_orderkey ASC) AS INTEGER) AS pos "
        f"FROM orders ORDER BY o_totalprice DESC, o_orderkey ASC LIMIT {LIMIT_N}"
    ),
    "union_all": _ORDERS_SELECT,
    "except_distinct": (
        f"WITH {_HALVES} SELECT o_custkey, o_orderpriority FROM early EXCEPT SELECT o_custkey, o_orderpriority FROM late"
    ),
    "diff_tables": (
        f"WITH {_HALVES}, "
        "a AS (SELECT o_custkey, o_orderpriority FROM early), b AS (SELECT o_custkey, o_orderpriority FROM late) "
        "SELECT 'left_only' AS side, o_custkey, o_orderpriority, COUNT(*) AS copies "
        "FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) GROUP BY o_custkey, o_orderpriority "
        "UNION ALL "
        "SELECT 'right_only' AS side, o_custkey, o_orderpriority, COUNT(*) AS copies "
        "FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) GROUP BY o_custkey, o_orderpriority"
    ),
    "bucket_diff": (
        "WITH now AS (SELECT * FROM orders), "
        "later AS (SELECT * REPLACE (CASE WHEN o_orderkey % 97 = 0 THEN o_totalprice + 1.0 ELSE o_totalprice END AS o_totalprice) "
        "FROM now WHERE o_orderkey % 101 <> 0 UNION ALL SELECT * FROM now WHERE o_orderkey % 89 = 0), "
        "a AS (SELECT {cols} FROM now), b AS (SELECT {cols} FROM later) "
        "SELECT 'left_only' AS side, {cols}, COUNT(*) AS copies FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) GROUP BY ALL "
        "UNION ALL "
        "SELECT 'right_only' AS side, {cols}, COUNT(*) AS copies FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) GROUP BY ALL"
    ).replace("{cols}", ", ".join(ORDER_COLUMNS)),
    "skewed_join": (
        "WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey % 50 + 1 END AS key FROM orders), "
        "s AS (SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 0 ELSE s_suppkey % 50 + 1 END AS key FROM supplier) "
        "SELECT key, COUNT(*) AS pairs, CAST(SUM(o_orderkey) AS BIGINT) AS orders, "
        "CAST(SUM(o_orderkey % 7 * s_suppkey) AS BIGINT) AS mixed FROM o JOIN s USING (key) GROUP BY key"
    ),
    "rank_all": (
        "WITH dated AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'hot' ELSE o_orderpriority END AS grp, "
        "CAST(o_orderdate AS DATE) AS day FROM orders) "
        "SELECT o_orderkey, grp, RANK() OVER w AS rank, DENSE_RANK() OVER w AS dense_rank "
        "FROM dated WINDOW w AS (PARTITION BY grp ORDER BY day DESC NULLS LAST)"
    ),
    "line_numbers": (
        "SELECT * FROM (SELECT ROW_NUMBER() OVER (ORDER BY o_orderkey) - 1 AS line_no, "
        "o_orderkey || ';' || o_custkey AS value FROM orders) WHERE line_no >= 10"
    ),
    "clustered_scan": (
        f"SELECT {', '.join(ORDER_COLUMNS)} FROM orders "
        "WHERE o_custkey BETWEEN 100 AND 400 AND o_totalprice BETWEEN 50000 AND 250000"
    ),
    "exact_avg": (
        "SELECT l_returnflag, COUNT(net) AS n, ROUND(fsum(net), 2) AS sum_net, ROUND(favg(net), 4) AS avg_net "
        "FROM (SELECT l_returnflag, l_extendedprice * (1 - l_discount) AS net FROM lineitem) GROUP BY l_returnflag"
    ),
    "currency_lenient": _sql(
        "SELECT zip_code, TRY_CAST(regexp_replace(median_income_raw, '[$,]', '', 'g') AS DOUBLE) AS median_income FROM income"
    ),
    "currency_strict": _sql("SELECT zipcode AS zip_code, median_income FROM inc_strict", _INCOME_STRICT),
    "inner_join": _JOIN,
    "join_broadcast": _JOIN,
    "join_merge": _JOIN,
    "join_shuffle_hash": _JOIN,
    "ratio_join": _sql(
        "SELECT c.zipcode, c.total_population, i.median_income, "
        "ROUND(i.median_income / CAST(c.total_population AS DOUBLE), 2) AS per_capita_income_2020_2021 "
        "FROM census c JOIN inc i ON c.zipcode = i.zipcode",
        _CENSUS,
        _INCOME_LENIENT,
    ),
    "ratio_join_strict": _sql(
        "SELECT c.zipcode, c.total_population, i.median_income, "
        "i.median_income / CAST(c.total_population AS DOUBLE) AS per_capita_income "
        "FROM census c JOIN inc_strict i ON c.zipcode = i.zipcode",
        _CENSUS,
        _INCOME_STRICT,
    ),
    "haversine": _sql(
        "SELECT event_id, CASE WHEN event_id % 103 <> 0 THEN ROUND("
        + _hav_sql("crime_lat", "crime_lon", f"CAST({REF_LAT} AS DOUBLE)", f"CAST({REF_LON} AS DOUBLE)")
        + ", 3) END AS km, CASE WHEN event_id % 103 = 0 THEN 'not a number' "
        "WHEN crime_lat IS NULL OR crime_lon IS NULL THEN 'missing' ELSE 'ok' END AS state FROM incidents"
    ),
    "nearest_per_location": _nearest_sql("location"),
    "nearest_per_event": _nearest_sql("event"),
    "csv_scan": _ORDERS_SELECT,
    "delimited_scan": _sql("SELECT zip_code, median_income_raw FROM income"),
    "text_scan": _sql("SELECT date_rptd AS value FROM orders_text"),
    "split_fields": _sql("SELECT zip_code, COALESCE(median_income_raw, '') AS median_income_raw FROM income"),
    "geojson_features": _sql(_BLOCK_POINTS),
    "geojson_document": _sql(_BLOCK_POINTS),
    "geojson_split": _sql(_BLOCK_POINTS),
    "geojson_oneline": _sql(_BLOCK_POINTS),
    "geojson_profile": _sql(
        "SELECT 'feature_type' AS kind, 'Feature' AS name, CAST(NULL AS VARCHAR) AS value_type, COUNT(*) AS features FROM blocks "
        "UNION ALL SELECT 'geometry_type', 'Polygon', NULL, COUNT(*) FROM blocks "
        "UNION ALL SELECT 'property', 'ZCTA20', "
        "CASE WHEN zcta IS NULL THEN 'VOID' WHEN pop % 2 = 1 THEN 'BIGINT' ELSE 'STRING' END, COUNT(*) FROM blocks GROUP BY 3 "
        "UNION ALL SELECT 'property', 'POP20', 'BIGINT', COUNT(*) FROM blocks"
    ),
    "parquet_roundtrip": _ORDERS_SELECT,
    "profile": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, COUNT(*) AS row_count, COUNT(*) - COUNT({c}) AS null_count FROM orders"
        for c, t in _PROFILE_TYPES.items()
    ),
}
ORACLE_SQL["haversine_udf"] = ORACLE_SQL["haversine"]
ORACLE_SQL["sql_topk_view"] = _TOPK
ORACLE_SQL["date_parts_parsed"] = _sql(
    "SELECT o_orderkey, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month "
    "FROM (SELECT o_orderkey, try_strptime(date_rptd, '%Y %b %d %I:%M:%S %p') AS ts FROM orders_text)"
)
ORACLE_SQL["share_by_bucket_csv"] = ORACLE_SQL["share_by_bucket"]
ORACLE_SQL["ratio_join_geojson"] = ORACLE_SQL["ratio_join"]
ORACLE_SQL["nearest_csv_sites"] = ORACLE_SQL["nearest_per_location"]
ORACLE_SQL["union_by_position"] = _ORDERS_SELECT

ORACLE_SQL["ratio_join_sql"] = ORACLE_SQL["ratio_join"]
ORACLE_SQL["ratio_join_raw"] = _sql(
    "SELECT c.zipcode, c.total_population, i.median_income, w.median_income_raw, "
    "ROUND(i.median_income / c.total_population, 2) AS per_capita_income_2020_2021 "
    "FROM census c JOIN inc i ON c.zipcode = i.zipcode JOIN income w ON w.zip_code = c.zipcode",
    _CENSUS,
    _INCOME_LENIENT,
)
ORACLE_SQL["sample_lines"] = _sql("SELECT substring(zip_code || ' ' || community, 1, 12) AS value FROM income")


def _nearest_km_sql(points: str, spots: str) -> str:
    """Least distance over all pairs, as the oracle may."""
    km = _hav_sql("p.lat", "p.lon", "s.site_lat", "s.site_lon")
    return _sql(
        f"SELECT p.lat, p.lon, p.n, ROUND(MIN({km}), 4) AS km FROM pts p CROSS JOIN spots s GROUP BY p.lat, p.lon, p.n",
        f"raw_pts AS ({points})",
        "pts AS (SELECT lat, lon, COUNT(*) AS n FROM raw_pts WHERE lat IS NOT NULL AND lon IS NOT NULL GROUP BY lat, lon)",
        f"spots AS (SELECT DISTINCT site_lat, site_lon FROM ({spots}))",
    )


def _customer_spots_sql(step: str) -> str:
    return (
        f"SELECT CAST(34.05 AS DOUBLE) + CAST(c_custkey % 31 AS DOUBLE) * CAST({step} AS DOUBLE) AS site_lat, "
        f"CAST(-118.25 AS DOUBLE) + CAST(c_custkey % 37 AS DOUBLE) * CAST({step} AS DOUBLE) AS site_lon FROM customer"
    )


def _order_places_sql(west: str) -> str:
    return (
        "SELECT CAST(-89.5 AS DOUBLE) + CAST(o_orderkey % 359 AS DOUBLE) / CAST(2.0 AS DOUBLE) AS lat, "
        f"CAST({west} AS DOUBLE) + CAST(o_orderkey * 7 % 719 AS DOUBLE) / CAST(2.0 AS DOUBLE) AS lon FROM orders"
    )


ORACLE_SQL["nearest_far"] = _nearest_km_sql(_order_places_sql("-179.75"), _customer_spots_sql("0.01"))
ORACLE_SQL["nearest_dense"] = _nearest_km_sql(
    "SELECT crime_lat AS lat, crime_lon AS lon FROM incidents", _customer_spots_sql("0.00003")
)
ORACLE_SQL["nearest_wide_longitudes"] = _nearest_km_sql(
    _order_places_sql("0.0"),
    "SELECT CAST(-88.25 AS DOUBLE) + CAST(s_suppkey * 13 % 353 AS DOUBLE) / CAST(2.0 AS DOUBLE) AS site_lat, "
    "CAST(0.25 AS DOUBLE) + CAST(s_suppkey * 29 % 719 AS DOUBLE) / CAST(2.0 AS DOUBLE) AS site_lon FROM supplier",
)

# Timing reports: their queries show what does not vary between runs.
TIMED = {
    "strategy_report": timed_strategies,
    "nearest_strategy_report": timed_nearest_strategies,
    "format_report": timed_formats,
    "conversion_report": timed_conversion,
    "api_report": timed_forms,
}


def _variants_sql(label: str, rows: dict[str, tuple[str, str]], body: str, *ctes: str) -> str:
    """A row per variant: its name, further columns and the row count of ``body``."""
    listed = " UNION ALL ".join(
        f"SELECT '{name}' AS {label}{', ' + more if more else ''}, (SELECT COUNT(*) FROM ({of or body})) AS rows"
        for name, (more, of) in rows.items()
    )
    return _sql(f"SELECT *, true AS same FROM ({listed})", *ctes)


_HINTED_NODES = {"broadcast": "BroadcastHashJoin", "merge": "SortMergeJoin", "shuffle_hash": "ShuffledHashJoin"}
_STRATEGY_ROWS = {
    s: (f"'{_HINTED_NODES[s]}' AS join_node" if s in _HINTED_NODES else "CAST(NULL AS VARCHAR) AS join_node", "")
    for s in REPORT_STRATEGIES
}
_C1_ROWS = f"SELECT DISTINCT {_TOD} AS time_of_day FROM incidents"
_C2_ROWS = f"SELECT * FROM ranked WHERE ranking <= {TOP_K}"
_C3_ROWS = "SELECT c.zipcode FROM census c JOIN inc i ON c.zipcode = i.zipcode"
ORACLE_SQL["strategy_report"] = (
    "SELECT *, rows AS join_rows FROM ("  # the one join's rows are the result's
    + _variants_sql("strategy", _STRATEGY_ROWS, _C3_ROWS, _CENSUS, _INCOME_LENIENT)
    + ")"
)
ORACLE_SQL["nearest_strategy_report"] = _variants_sql(
    "strategy", _STRATEGY_ROWS, f"SELECT 1 FROM ({ORACLE_SQL['nearest_per_location']})"
)
ORACLE_SQL["format_report"] = _variants_sql(
    "format", {name: ("", "") for name in ("parquet", "csv", "csv_inferred")}, _C1_ROWS
)
ORACLE_SQL["conversion_report"] = _sql(
    "SELECT 'csv_to_parquet' AS job, COUNT(*) AS rows, CAST(5 AS INTEGER) AS columns FROM incidents"
)
_FORMS = [
    *[("C1", api, f"{_C1_ROWS} WHERE time_occ IS NOT NULL") for api in ("expression", "pandas_udf", "sql")],
    *[("C2", api, _C2_ROWS) for api in ("dataframe", "sql", "sql_view")],
    *[("C3", api, _C3_ROWS) for api in ("dataframe", "sql")],
]
ORACLE_SQL["api_report"] = _sql(
    " UNION ALL ".join(
        f"SELECT '{query}' AS query, '{api}' AS api, (SELECT COUNT(*) FROM ({of})) AS rows, true AS same"
        for query, api, of in _FORMS
    ),
    _PARTS,
    _COUNTS,
    _RANKED,
    _CENSUS,
    _INCOME_LENIENT,
)

assert set(ORACLE_SQL) == set(QUERIES), sorted(set(QUERIES) ^ set(ORACLE_SQL))
