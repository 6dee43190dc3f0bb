"""Property tests: the Spark expressions against small Python models of the
rules they implement, over generated inputs (one Spark job per example)."""

import re
from bisect import bisect_right

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from metrolens.functions import parse_currency, time_of_day

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


# First minute of each stretch of the day and its name; what is outside 0500-2059 is night.
STARTS = [500, 1200, 1700, 2100]
NAMES = ["Night", "Morning", "Afternoon", "Evening", "Night"]
# Numbers that are no clock time between two stretches (1160-1199 and so on) belong to none of them.
GAPS = [range(1160, 1200), range(1660, 1700), range(2060, 2100)]


def named_stretch(hhmm):
    if hhmm is None or any(hhmm in gap for gap in GAPS):
        return "Night"
    return NAMES[bisect_right(STARTS, hhmm)]


# Money: digits with any dollar signs and commas strewn in, and at most one point; nothing else but outer space.
AMOUNT = re.compile(r"[$,]*(?:[0-9][$,0-9]*(?:\.[$,0-9]*)?|\.[$,]*[0-9][$,0-9]*)")


def amount(raw):
    if raw is None or not AMOUNT.fullmatch(raw.strip()):
        return None
    return float(re.sub("[$,]", "", raw))


def lenient_model(raw):
    if raw is None:
        return None
    try:
        return float(raw.replace("$", "").replace(",", "").strip())
    except ValueError:
        return None


MONEY = st.one_of(
    st.none(),
    st.text(alphabet="0123456789$,.- \t", max_size=9),
    st.builds(lambda n, c: f"${n:,}" + c, st.integers(0, 10**7), st.sampled_from(["", ".5", ".25", " "])),
    st.sampled_from(["---", "", "$", ".", "$.", "1.2.3", "-5", " 45 ", "$1,234.50"]),
)


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(-3000, 3000)), min_size=1, max_size=200))
def test_time_of_day_matches_model(spark, times):
    df = spark.createDataFrame([(t,) for t in times], "t int")
    got = [r.label for r in df.select(time_of_day("t").alias("label")).collect()]
    assert got == [named_stretch(t) for t in times]


@SETTINGS
@given(st.lists(MONEY, min_size=1, max_size=200))
def test_currency_matches_models(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "raw string")
    rows = df.select(
        parse_currency("raw", strict=True).alias("strict"), parse_currency("raw").alias("lenient")
    ).collect()
    for raw, row in zip(values, rows):
        assert row.strict == amount(raw), raw
        assert row.lenient == lenient_model(raw), raw


@pytest.mark.parametrize(
    "hhmm,name",
    [
        (0, "Night"), (459, "Night"), (500, "Morning"), (1159, "Morning"), (1160, "Night"), (1200, "Afternoon"),
        (1659, "Afternoon"), (1660, "Night"), (1700, "Evening"), (2059, "Evening"), (2060, "Night"), (2100, "Night"),
        (-1, "Night"), (None, "Night"),
    ],
)
def test_edges_of_the_day(hhmm, name):
    assert named_stretch(hhmm) == name


@pytest.mark.parametrize(
    "raw,value",
    [
        ("$23,137", 23137.0), (" 45 ", 45.0), ("1.5", 1.5), (".5", 0.5), ("5.", 5.0), ("---", None), ("", None),
        ("$", None), (".", None), ("1.2.3", None), ("-5", None), ("4 5", None), (None, None),
    ],
)
def test_amounts(raw, value):
    assert amount(raw) == value
