"""Cell parsing, exact prices and business days against plain Python."""

import datetime as dt
from decimal import Decimal
from fractions import Fraction

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tickloom.functions import cells
from tickloom.functions.days import business_days, day_key, is_weekday, market_time
from tickloom.functions.pricing import exact_ratio


def evaluate(spark, rows, schema, *columns):
    frame = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"_i int, {schema}")
    found = frame.select("_i", *columns).orderBy("_i").collect()
    return [tuple(row)[1:] for row in found]


CLOCKS = {
    "90501": "09", "090501": "09", "09:05:02": "09", "9:05:02": "09", "235959": "23",
    "123": "00", "": "00", None: None, "12345678": "12", "990000": "99", "::": "00",
}


def test_hour_bucket(spark):
    got = evaluate(spark, [(c,) for c in CLOCKS], "c string", cells.hour_bucket("c"))
    assert [g[0] for g in got] == list(CLOCKS.values())


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(max_size=12), min_size=20, max_size=60))
def test_hour_bucket_has_two_characters_for_any_text(spark, texts):
    got = evaluate(spark, [(t,) for t in texts], "c string", cells.hour_bucket("c"))
    assert [g[0] for g in got] == [t.replace(":", "").rjust(6, "0")[:2] for t in texts]


def test_cells(spark):
    rows = [(" 7 ",), ("x",), ("3.7",), ("",), (None,), ("38500.5",), ("99999999999",)]
    got = evaluate(spark, rows, "c string", cells.whole("c"), cells.price("c"), cells.cents("c"))
    assert [g[0] for g in got] == [7, None, None, None, None, None, None]
    assert [g[1] for g in got] == [
        Decimal("7.0000"), None, Decimal("3.7000"), None, None, Decimal("38500.5000"),
        Decimal("99999999999.0000"),
    ]
    assert evaluate(spark, [("3850050",)], "c string", cells.cents("c")) == [(38500.5,)]


def test_text_trims_spaces_only(spark):
    rows = [("NK ",), ("\tNK",), ("  a b ",)]
    assert evaluate(spark, rows, "c string", cells.text("c")) == [("NK",), ("\tNK",), ("a b",)]


def test_trade_date(spark):
    rows = [("20260529",), (" 20260529",), ("abc",), ("",), (None,), ("20260230",), ("2026052",)]
    got = evaluate(spark, rows, "c string", cells.trade_date("c"))
    day = dt.date(2026, 5, 29)
    assert [g[0] for g in got] == [day, day, None, None, None, None, None]


def rounded(amount: Decimal, units: int):
    if not units:
        return None
    exact = Fraction(amount) / units
    steps = abs(exact) * 10_000
    whole = steps.numerator // steps.denominator
    whole += 2 * (steps - whole) >= 1
    return Decimal(whole if exact >= 0 else -whole).scaleb(-4)


AMOUNTS = st.integers(-(10**24), 10**24).map(lambda n: Decimal(n).scaleb(-4))
UNITS = st.one_of(st.integers(10**12, 2**62), st.integers(-(10**4), 10**4), st.just(0))


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(AMOUNTS, UNITS), min_size=30, max_size=60))
def test_exact_ratio_rounds_once(spark, pairs):
    # A price fits decimal(18,4); keep quotients within it.
    pairs = [(a, u) for a, u in pairs if not u or abs(a) / abs(u) < 10**14] or [(Decimal(1), 1)]
    got = evaluate(spark, pairs, "a decimal(38,4), u bigint", exact_ratio(F.col("a"), F.col("u")))
    assert [g[0] for g in got] == [rounded(a, u) for a, u in pairs]


def test_exact_ratio_ties(spark):
    pairs = [(Decimal("0.0001"), 2), (Decimal("-0.0001"), 2), (Decimal("0.0003"), 2), (None, 2)]
    got = evaluate(spark, pairs, "a decimal(38,4), u bigint", exact_ratio(F.col("a"), F.col("u")))
    assert [g[0] for g in got] == [Decimal("0.0001"), Decimal("-0.0001"), Decimal("0.0002"), None]


def days_one_by_one(a, b, inclusive):
    if a == b:
        return 0
    low, high = min(a, b), max(a, b)
    n = sum((low + dt.timedelta(i)).weekday() < 5 for i in range(1, (high - low).days + 1))
    n += inclusive and low.weekday() < 5
    return -n if a > b else n


DAYS = st.dates(dt.date(1960, 1, 1), dt.date(2040, 1, 1))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(DAYS, st.integers(-40, 40)), min_size=40, max_size=80))
def test_business_days(spark, pairs):
    spans = [(a, a + dt.timedelta(n)) for a, n in pairs]
    a, b = F.col("a"), F.col("b")
    got = evaluate(
        spark, spans, "a date, b date",
        business_days(a, b), business_days(a, b, inclusive=False), business_days(b, a),
    )
    for (x, y), (both, one, back) in zip(spans, got):
        assert both == days_one_by_one(x, y, True)
        assert one == days_one_by_one(x, y, False)
        assert back == -both


def test_day_columns(spark):
    day = dt.date(2026, 5, 29)
    rows = [(day, "09"), (day, "99"), (day, "zz"), (dt.date(2026, 5, 30), None)]
    got = evaluate(
        spark, rows, "d date, h string",
        market_time(F.col("d"), F.col("h")), is_weekday(F.col("d")), day_key(F.col("d")),
    )
    assert got == [
        (dt.datetime(2026, 5, 29, 9), True, "20260529"),
        (dt.datetime(2026, 6, 2, 3), True, "20260529"),
        (None, True, "20260529"),
        (None, False, "20260530"),
    ]


@pytest.mark.parametrize("inclusive, expected", [(True, 2), (False, 1)])
def test_weekend_between(spark, inclusive, expected):
    row = spark.range(1).select(
        business_days(F.lit(dt.date(2026, 5, 29)), F.lit(dt.date(2026, 6, 1)), inclusive)
    ).first()
    assert row[0] == expected
