"""Column functions on hand-made values, including blank, NULL and ambiguous ones."""

import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierline import functions as fn


def _one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expression(F.col("v")).alias("r")).first().r


def _md5(text):
    return hashlib.md5(text.encode()).hexdigest()


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2026-01-31", dt.date(2026, 1, 31)),
        (" 2026-01-31 ", dt.date(2026, 1, 31)),
        ("01-Jan-26", dt.date(2026, 1, 1)),
        ("31/12/2026", dt.date(2026, 12, 31)),
        ("12/31/2026", dt.date(2026, 12, 31)),
        ("03/04/26", dt.date(2026, 4, 3)),
        ("2026/12/31", dt.date(2026, 12, 31)),
        ("31/31/2026", None),
        ("n/a", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_date(spark, text, expected):
    assert _one(spark, text, fn.parse_date) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("5.541656101035829E7", Decimal("55416561.010358")),
        ("1.02886535219e-7", Decimal("0.000000")),
        ("8,510,244.027614748", Decimal("8510244.027615")),
        ("-12", Decimal("-12.000000")),
        ("  7.5 ", Decimal("7.500000")),
        ("", None),
        ("   ", None),
        ("n/a", None),
        (None, None),
    ],
)
def test_clean_decimal(spark, text, expected):
    assert _one(spark, text, lambda v: fn.clean_decimal(v, "decimal(18,6)")) == expected


def test_clean_decimal_keeps_small_exponents(spark):
    value = _one(spark, "1.02886535219e-7", lambda v: fn.clean_decimal(v, "decimal(38,18)"))
    assert value == Decimal("1.02886535219e-7")


@pytest.mark.parametrize(
    "text, expected",
    [("20260409", "2026-04-09"), ("2026-04-09", "2026-04-09"), ("", ""), (None, None), ("9/4/2026", "9/4/2026")],
)
def test_iso_date_text(spark, text, expected):
    assert _one(spark, text, fn.iso_date_text) == expected


def test_keys_ignore_spelling(spark):
    assert _one(spark, " ABC ", fn.natural_key) == _one(spark, "abc", fn.natural_key) == _md5("abc")
    assert _one(spark, None, fn.natural_key) is None
    assert _one(spark, None, fn.key_or_unknown) == _md5("unknown")
    assert _one(spark, "", fn.key_or_unknown) == _md5("")


def test_int_key(spark):
    assert _one(spark, "abc", fn.int_key) == int(_md5("abc")[:15], 16)
    assert _one(spark, None, fn.int_key) is None
    pairs = spark.createDataFrame([("A", None), (None, "A"), ("a|b", "c"), ("a", "b|c"), ("1:a", "b")], "x string, y string")
    keys = {r[0] for r in pairs.select(fn.int_key(F.col("x"), F.col("y"))).collect()}
    hashes = {r[0] for r in pairs.select(fn.row_hash(F.col("x"), F.col("y"))).collect()}
    assert len(keys) == len(hashes) == 5


def test_row_hash_tells_null_from_empty_and_keeps_positions(spark):
    rows = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a", "", "b")], "x string, y string, z string")
    hashes = [r.h for r in rows.select(fn.row_hash(F.col("x"), F.col("y"), F.col("z")).alias("h")).collect()]
    assert len(set(hashes)) == 3


def test_variance_pct(spark):
    df = spark.createDataFrame(
        [(Decimal("12"), Decimal("10")), (Decimal("5"), Decimal("0")), (Decimal("0"), Decimal("4"))],
        "f decimal(30,6), a decimal(30,6)",
    )
    got = [r.p for r in df.select(fn.variance_pct(F.col("f"), F.col("a")).alias("p")).collect()]
    assert got == [Decimal("20.00"), None, Decimal("-100.00")]


def test_indicator(spark):
    assert [_one(spark, v, fn.describe_indicator) for v in ("F", "A", "X", None)] == [
        "Forecast", "Actual", "Unknown", "Unknown",
    ]
    assert [_one(spark, v, fn.is_forecast) for v in ("F", "A", None)] == [True, False, None]


def test_date_parts(spark):
    day = dt.date(2024, 7, 9)
    assert _one(spark, day, fn.date_key, "date") == "2024-07-09"
    assert _one(spark, day, fn.year_month, "date") == "2024-07"


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-(10**15), 10**15), min_size=1, max_size=20))
def test_grouped_and_exponent_spellings_give_the_same_number(spark, cents):
    def spellings(c):
        sign, whole, rest = "-" if c < 0 else "", abs(c) // 100, abs(c) % 100
        return f"{sign}{whole:,}.{rest:02d}", f"{c}E-2", f"{sign}{whole}.{rest:02d}"

    df = spark.createDataFrame([spellings(c) for c in cents], "a string, b string, p string")
    kind = "decimal(20,2)"
    row = df.select([fn.clean_decimal(F.col(c), kind).alias(c) for c in df.columns]).filter("a <> b OR b <> p").count()
    assert row == 0
