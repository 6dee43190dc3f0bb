"""Column-level functions: native expressions first, Arrow-batched twins where the reference used UDFs."""

from metrolens.functions.buckets import (
    NULL_POLICIES,
    TIME_OF_DAY_BANDS,
    TIME_OF_DAY_DEFAULT,
    bucket,
    bucket_udf,
    time_of_day,
    time_of_day_udf,
)
from metrolens.functions.casts import cast_columns, try_cast
from metrolens.functions.currency import currency_is_valid, parse_currency
from metrolens.functions.dates import MONTH_ABBREVIATIONS, date_parts, month_number, year_prefix
from metrolens.functions.geo import EARTH_RADIUS_KM, haversine_km, haversine_km_udf

__all__ = [
    "NULL_POLICIES",
    "TIME_OF_DAY_BANDS",
    "TIME_OF_DAY_DEFAULT",
    "bucket",
    "bucket_udf",
    "time_of_day",
    "time_of_day_udf",
    "cast_columns",
    "try_cast",
    "currency_is_valid",
    "parse_currency",
    "MONTH_ABBREVIATIONS",
    "date_parts",
    "month_number",
    "year_prefix",
    "EARTH_RADIUS_KM",
    "haversine_km",
    "haversine_km_udf",
]
