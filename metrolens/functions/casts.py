"""ANSI-safe projection with casts: bad text becomes NULL instead of failing the job."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame

from metrolens.functions._util import as_col


def try_cast(c: Column | str, data_type: str) -> Column:
    return as_col(c).try_cast(data_type)


def cast_columns(df: DataFrame, spec: Mapping[str, tuple[Column | str, str | None]]) -> DataFrame:
    """Select ``{output_name: (source, type)}``; ``type=None`` keeps the source type.

    Every cast is a ``try_cast``: with ANSI mode on, a plain ``cast`` of
    ``'---'`` to DOUBLE throws.
    """
    cols = []
    for name, (source, data_type) in spec.items():
        c = as_col(source)
        cols.append((c.try_cast(data_type) if data_type else c).alias(name))
    return df.select(*cols)
