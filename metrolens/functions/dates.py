"""Year and month from text dates such as '2010 Feb 20 12:00:00 AM'."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from metrolens.functions._util import as_col

# English month abbreviations, January first. Lookup is exact and
# case-sensitive ('FEB' has no month).
MONTH_ABBREVIATIONS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def _month_map() -> Column:
    pairs = []
    for number, name in enumerate(MONTH_ABBREVIATIONS, start=1):
        pairs += [F.lit(name), F.lit(number)]
    return F.create_map(*pairs)


def month_number(c: Column | str) -> Column:
    """Abbreviation -> 1..12, anything else -> NULL."""
    return F.try_element_at(_month_map(), as_col(c))


def year_prefix(c: Column | str, pos: int = 1, length: int = 4) -> Column:
    """Integer year from a fixed text slice; unparsable text -> NULL (positions are 1-based)."""
    return F.substring(as_col(c), pos, length).try_cast("int")


# Fixed value: the layout of incident report dates, e.g. '2010 Feb 20 12:00:00 AM'.
INCIDENT_DATE_PATTERN = "yyyy MMM dd hh:mm:ss a"

DATE_MODES = ("slice", "parse")


def date_parts(
    c: Column | str,
    year_pos: int = 1,
    month_pos: int = 6,
    mode: str = "slice",
    pattern: str = INCIDENT_DATE_PATTERN,
) -> tuple[Column, Column]:
    """(year, month) columns for a 'yyyy MMM ...' text date.

    ``mode="slice"`` (default) reads fixed positions: the year is the integer
    at ``year_pos`` and the month the exact, case-sensitive abbreviation at
    ``month_pos`` ('FEB' -> NULL), so a text with a valid prefix but an
    impossible day still counts. ``mode="parse"`` parses the whole text with
    ``pattern`` via ``try_to_timestamp``: month names match in any case, and
    an impossible date such as 'Feb 30' gives NULL for both parts.
    """
    if mode not in DATE_MODES:
        raise ValueError(f"mode must be one of {DATE_MODES}")
    text = as_col(c)
    if mode == "parse":
        ts = F.try_to_timestamp(text, F.lit(pattern))
        return F.year(ts), F.month(ts)
    return year_prefix(text, year_pos), month_number(F.substring(text, month_pos, 3))
