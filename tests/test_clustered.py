"""Clustered Parquet tables and numbered lines."""

import datetime
import os
import random

import pytest
from pyspark.sql import functions as F

from metrolens.sources import file_ranges, number_lines, read_range, write_clustered
from metrolens.plans import plan_text


def _table(spark, n=20_000):
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") * 7919 % 1000).cast("int"))
    return spark.range(0, n, 1, 4).select(
        "id",
        (F.col("id") * 104729 % 10007).alias("a"),
        F.when(F.col("id") % 50 != 0, (F.col("id") * 31 % 997) / 7.0).alias("b"),
        day.alias("day"),
        F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.sha2(F.col("id").cast("string"), 256)).alias("text"),
    )


def test_range_filters_skip_files_of_even_size(spark, tmp_path):
    path, df = str(tmp_path / "t"), _table(spark)
    assert write_clustered(df, path, ["a", "b"], file_bytes=40_000) == path
    files = file_ranges(spark, path)
    assert len(files) > 8 and sum(f["rows"] for f in files) == 20_000
    sizes = [f["bytes"] for f in files]
    assert max(sizes) < 3 * sum(sizes) / len(sizes) and 15_000 < sum(sizes) / len(sizes) < 100_000
    for f in files:  # the footers tell what the file holds
        row = spark.read.parquet(f["file"]).agg(F.min("a"), F.max("a")).first()
        assert tuple(row) == f["ranges"]["a"]
    got = read_range(spark, path, {"a": (100, 900), "b": (1.0, 30.0)})
    want = df.filter("a BETWEEN 100 AND 900 AND b BETWEEN 1 AND 30")
    assert sorted(got.collect()) == sorted(want.collect())
    opened = len(got.inputFiles())
    assert 0 < opened <= len(files) / 2
    assert "PushedFilters: [IsNotNull(a)" in plan_text(got)
    assert read_range(spark, path, {"a": (20_000, 30_000)}).collect() == []


def test_dates_strings_and_one_heavy_value(spark, tmp_path):
    path, df = str(tmp_path / "t"), _table(spark).withColumn("hot", F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 900))
    write_clustered(df, path, ["hot", "day"], file_bytes=40_000)
    files = file_ranges(spark, path)
    assert max(f["rows"] for f in files) < 20_000 / 3  # a third of the rows has one value
    low, high = datetime.date(2020, 3, 1), datetime.date(2020, 4, 1)
    got = read_range(spark, path, {"day": (low, high), "text": ("same", "same")})
    want = df.filter((F.col("day").between(F.lit(low), F.lit(high))) & (F.col("text") == "same"))
    assert sorted(got.collect()) == sorted(want.collect())
    with pytest.raises(ValueError):
        write_clustered(df, path, ["text"])


def test_files_are_picked_by_the_index_written_with_the_table(spark, tmp_path, monkeypatch):
    from metrolens.sources import clustered

    path = str(tmp_path / "t")
    price = F.when(F.col("id") % 50 != 0, (F.col("id") * 31 % 997).cast("decimal(9,2)"))
    df = _table(spark).withColumns({"price": price, "at": F.col("day").cast("timestamp"), "x y": F.col("a")})
    write_clustered(df, path, ["price", "at"], file_bytes=60_000)
    index = spark.read.parquet(f"{path}/_ranges/files")
    assert index.count() == len(spark.read.parquet(path).inputFiles()) > 4
    assert index.agg(F.sum("rows")).first()[0] == spark.read.parquet(path).count() == 20_000

    calls = []
    hadoop = clustered._hadoop
    monkeypatch.setattr(clustered, "_hadoop", lambda spark, at: calls.append(at) or hadoop(spark, at))
    low, high = datetime.datetime(2020, 3, 1), datetime.datetime(2020, 8, 1)
    ranges = {"price": (100, 300), "at": (low, high), "x y": (0, 10_000)}
    got = read_range(spark, path, ranges)
    assert calls == [f"{path}/_ranges/files"]  # no file is looked into by the driver
    want = df.filter(F.col("price").between(100, 300) & F.col("at").between(F.lit(low), F.lit(high)))
    assert sorted(got.collect()) == sorted(want.collect()) != []
    assert len(got.inputFiles()) < index.count()

    # a file that came later, and a table without an index
    df.filter("id = 7").withColumn("price", F.lit(250).cast("decimal(9,2)")).write.mode("append").parquet(path)
    assert read_range(spark, path, {"price": (250, 250), "id": (7, 7)}).count() == 1
    assert sum(f["rows"] for f in file_ranges(spark, path)) == 20_001
    df.write.parquet(str(tmp_path / "plain"))
    assert read_range(spark, str(tmp_path / "plain"), ranges).count() == want.count()


def test_a_table_is_replaced_whole(spark, tmp_path):
    path, df = str(tmp_path / "t"), _table(spark, 500)
    write_clustered(df, path, ["a"])
    write_clustered(df.filter("id < 100"), path, ["a"])
    assert spark.read.parquet(path).count() == 100
    assert sorted(os.listdir(tmp_path)) == ["t"]
    empty = write_clustered(df.limit(0), str(tmp_path / "none"), ["a"])
    assert read_range(spark, empty, {"a": (0, 10)}).collect() == []


@pytest.mark.parametrize("size", [1 << 20, 700])
def test_lines_are_numbered_over_files_and_splits(spark, tmp_path, size):
    rnd = random.Random(size)
    want = []
    for name in ("b.txt", "a.txt", "c.txt"):
        lines = ["" if rnd.random() < 0.1 else "x" * rnd.randint(0, 60) + str(i) for i in range(200)]
        (tmp_path / name).write_text("\n".join(lines) + ("\n" if name != "c.txt" else ""))
        want.append((name, lines))
    flat = [line for _, lines in sorted(want) for line in lines]
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = number_lines(spark, str(tmp_path)).collect()
        later = number_lines(spark, [str(tmp_path / n) for n, _ in want], name="n", skip=3)
        assert sorted(tuple(r) for r in later.collect()) == list(enumerate(flat))[3:]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted((r.line_no, r.value) for r in got) == list(enumerate(flat))
