"""Range bucketing of an integer column (time of day and similar)."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from metrolens.functions._util import as_col

# Time-of-day bands over HHMM codes, inclusive bounds, checked in
# this order. Every other code (including 460-499, 1160-1199, 1660-1699,
# 2060-2099, >= 2100 and negatives) takes the default label.
TIME_OF_DAY_BANDS: tuple[tuple[int, int, str], ...] = (
    (500, 1159, "Morning"),
    (1200, 1659, "Afternoon"),
    (1700, 2059, "Evening"),
)
TIME_OF_DAY_DEFAULT = "Night"

# What a NULL input becomes:
#   "default" -> the default label (the plain when/otherwise chain does this),
#   "group"   -> a NULL label, kept as its own group,
#   "drop"    -> a NULL label that aggregating operators filter out.
NULL_POLICIES = ("default", "group", "drop")

Band = tuple[int, int, str]


def _check_policy(null_policy: str) -> None:
    if null_policy not in NULL_POLICIES:
        raise ValueError(f"null_policy must be one of {NULL_POLICIES}, got {null_policy!r}")


def bucket(
    c: Column | str,
    bands: Sequence[Band],
    default: str,
    null_policy: str = "default",
) -> Column:
    """Label ``c`` by the first band whose closed range contains it.

    Pure Catalyst expression: stays inside whole-stage codegen.
    """
    _check_policy(null_policy)
    if not bands:
        raise ValueError("bands must not be empty")
    value = as_col(c)
    expr = None
    for lo, hi, label in bands:
        cond = value.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    expr = expr.otherwise(default)
    if null_policy == "default":
        return expr
    return F.when(value.isNull(), F.lit(None).cast("string")).otherwise(expr)


def bucket_udf(bands: Sequence[Band], default: str):
    """Arrow-batched twin of :func:`bucket` with the reference UDF's null rule (NULL in, NULL out)."""
    bands = tuple(bands)

    @pandas_udf(StringType())
    def _label(values: pd.Series) -> pd.Series:
        out = pd.Series(default, index=values.index, dtype=object)
        # Later assignments win, so walk the bands backwards to let the first band take precedence.
        for lo, hi, label in reversed(bands):
            out[(values >= lo) & (values <= hi)] = label
        out[values.isna()] = None
        return out

    return _label


def time_of_day(c: Column | str, null_policy: str = "default") -> Column:
    return bucket(c, TIME_OF_DAY_BANDS, TIME_OF_DAY_DEFAULT, null_policy)


_TIME_OF_DAY_UDF = None


def time_of_day_udf(c: Column | str) -> Column:
    global _TIME_OF_DAY_UDF
    if _TIME_OF_DAY_UDF is None:
        _TIME_OF_DAY_UDF = bucket_udf(TIME_OF_DAY_BANDS, TIME_OF_DAY_DEFAULT)
    return _TIME_OF_DAY_UDF(as_col(c))
