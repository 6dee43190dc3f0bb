"""Source profiling: columns, types, row and null counts in one aggregate pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile(df: DataFrame) -> DataFrame:
    """One row per column: (column_name, data_type, row_count, null_count).

    A single ``agg`` computes every count (one scan, partial aggregation),
    then ``stack`` turns the one wide row into one row per column.
    """
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"__n{i}") for i, f in enumerate(fields)]
    wide = df.agg(*aggs)
    stack_args = ", ".join(
        f"'{f.name.replace(chr(39), chr(39) * 2)}', '{f.dataType.simpleString()}', `__n{i}`"
        for i, f in enumerate(fields)
    )
    return wide.selectExpr(
        f"stack({len(fields)}, {stack_args}) AS (column_name, data_type, null_count)", "__rows AS row_count"
    ).select("column_name", "data_type", "row_count", "null_count")
