"""Sums and means of doubles that do not depend on the order of rows.

Adding doubles rounds at every step, so a sum changes with the partitioning.
Here every value is cut, without rounding, into whole multiples of fixed powers
of two. Multiples of one power are integers, which add in any order; the few
that a group has are put together exactly and rounded once, at the end.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

WIDTH = 30  # bits of a piece
LOWEST = -1074  # exponent of the least double
PIECES = 4  # 53 bits over pieces of 30, and one more for a rounded logarithm


def pieces(value: Column) -> Column:
    """``array<struct<power int, times bigint>>`` whose sum of ``times * 2**power`` is ``value`` exactly."""
    top = F.floor(F.log2(F.abs(value)) / F.lit(float(WIDTH))).cast("int")
    powers = F.transform(
        F.sequence(F.lit(0), F.lit(PIECES - 1)), lambda i: F.greatest((top - i) * WIDTH, F.lit(LOWEST)).cast("int")
    )
    # Each step takes the whole multiples of a power and hands on the rest: both are exact.
    def step(held: Column, power: Column) -> Column:
        unit = F.pow(F.lit(2.0), power.cast("double"))
        scaled = held["rest"] / unit
        times = F.when(scaled < 0, F.ceil(scaled)).otherwise(F.floor(scaled)).cast("bigint")
        return F.struct(
            (held["rest"] - times.cast("double") * unit).alias("rest"),
            F.concat(held["out"], F.array(F.struct(power.alias("power"), times.alias("times")))).alias("out"),
        )

    empty = F.array().cast("array<struct<power:int,times:bigint>>")
    start = F.struct(value.alias("rest"), empty.alias("out"))
    return F.aggregate(F.array_distinct(powers), start, step, lambda held: held["out"])


def _whole(parts) -> Fraction:
    total = Fraction(0)
    for p in parts:
        times = int(p["times"])
        total += Fraction(times << p["power"]) if p["power"] >= 0 else Fraction(times, 1 << -p["power"])
    return total


def _rounded(value: Fraction) -> float:
    try:
        return float(value.numerator / value.denominator)  # correctly rounded for whole numbers of any size
    except OverflowError:
        return float("inf") if value > 0 else float("-inf")


@pandas_udf(DoubleType())
def _sum_of(parts: pd.Series) -> pd.Series:
    return pd.Series([_rounded(_whole(p)) for p in parts], dtype="float64")


@pandas_udf(DoubleType())
def _mean_of(parts: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series([_rounded(_whole(p) / int(k)) if k else None for p, k in zip(parts, n)], dtype="float64")


def exact_stats(
    df: DataFrame, keys: Sequence[str], value: str | Column, sum_name: str = "sum", avg_name: str = "avg", n_name: str = "n"
) -> DataFrame:
    """Per group of ``keys``: the number of given values, their sum and their
    mean, each the exact result rounded once to a double.

    NULLs do not count; a group of NULLs has 0, NULL and NULL. NaN, or both
    infinities, give NaN; one infinity gives itself. Two partial aggregations:
    pieces of equal power are summed in the map tasks, and a group has at most
    71 powers whatever its size.
    """
    given = (F.col(f"`{value}`") if isinstance(value, str) else value).cast("double")
    named = [F.col(f"`{k}`") for k in keys]
    rows = df.select(*named, given.alias("__v"))
    finite = F.col("__v").isNotNull() & ~F.isnan("__v") & (F.abs("__v") != float("inf"))
    cut = F.when(finite & (F.col("__v") != 0.0), pieces(F.col("__v")))
    parted = rows.select(*named, "__v", F.posexplode_outer(cut).alias("__i", "__p"))
    first = F.coalesce(F.col("__i"), F.lit(0)) == 0  # a value counts once
    folded = parted.groupBy(*named, F.col("__p.power").alias("power")).agg(
        F.sum(F.col("__p.times").cast("decimal(38,0)")).alias("times"),
        F.count_if(first & F.col("__v").isNotNull()).alias("n"),
        F.count_if(first & F.isnan("__v")).alias("nan"),
        F.count_if(first & (F.col("__v") == float("inf"))).alias("up"),
        F.count_if(first & (F.col("__v") == float("-inf"))).alias("down"),
    )
    grouped = folded.groupBy(*named).agg(
        F.collect_list(F.when(F.col("power").isNotNull(), F.struct("power", F.col("times").cast("string").alias("times")))).alias("parts"),
        F.sum("n").alias(n_name),
        F.sum("nan").alias("nan"),
        F.sum("up").alias("up"),
        F.sum("down").alias("down"),
    )

    def special(exact: Column) -> Column:
        return (
            F.when(F.col(n_name) == 0, F.lit(None).cast("double"))
            .when((F.col("nan") > 0) | ((F.col("up") > 0) & (F.col("down") > 0)), F.lit(float("nan")))
            .when(F.col("up") > 0, F.lit(float("inf")))
            .when(F.col("down") > 0, F.lit(float("-inf")))
            .otherwise(exact)
        )

    return grouped.select(
        *named,
        n_name,
        special(_sum_of("parts")).alias(sum_name),
        special(_mean_of("parts", F.col(n_name))).alias(avg_name),
    )
