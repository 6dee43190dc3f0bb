"""Formatted money text ('$45,000', '---', blanks) to DOUBLE."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from metrolens.functions._util import as_col

# Characters removed from money text before parsing.
CURRENCY_NOISE = "$,"


def _strip(c: Column) -> Column:
    # Trim all surrounding whitespace (tabs and newlines too), not just spaces.
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def currency_is_valid(c: Column | str) -> Column:
    """Strict validity: after trimming and removing '$' and ',', only digits
    with at most one '.', and at least one digit. '---', blanks and signs fail."""
    digits = F.translate(_strip(as_col(c)), CURRENCY_NOISE, "")
    return F.coalesce(digits.rlike(r"^[0-9]*\.?[0-9]*$") & digits.rlike(r"[0-9]"), F.lit(False))


def parse_currency(c: Column | str, strict: bool = False) -> Column:
    """Money text to DOUBLE.

    ``strict=False``: drop '$' and ',' and ``try_cast`` (bad text -> NULL, the row is kept).
    ``strict=True``: NULL unless :func:`currency_is_valid`; callers drop those rows.
    """
    value = as_col(c)
    if not strict:
        return F.regexp_replace(value, r"[$,]", "").try_cast("double")
    digits = F.translate(_strip(value), CURRENCY_NOISE, "")
    return F.when(currency_is_valid(value), digits.try_cast("double"))
