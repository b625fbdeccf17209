"""Golden rows for the column functions."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from fuelscope.functions import arith, clock, text
from fuelscope.schema import DAILY_AVG, RBOB, RETAIL, RUNS, STOCKS


def one(spark, value, build, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(build(F.col("x")).alias("y")).first()[0]


@pytest.mark.parametrize(
    "shown, want",
    [("$3.152", 3.152), ("1,234.5", 1234.5), ("-2.1M", 2.1), ("1.2.3", None), ("", None), (None, None), (".", None)],
)
def test_parse_price(spark, shown, want):
    assert one(spark, shown, text.parse_price) == want


@pytest.mark.parametrize("shown, want", [(" $ 3.1 ", 3.1), ("$-2", -2.0), ("abc", None), ("1d", None), ("NaN", None)])
def test_dollar_price(spark, shown, want):
    assert one(spark, shown, text.dollar_price) == want


@pytest.mark.parametrize("shown, want", [("-2.1M", -2.1), ("M", None), ("3", 3.0)])
def test_magnitude(spark, shown, want):
    assert one(spark, shown, text.magnitude) == want


def test_missing_consensus(spark):
    assert one(spark, " ", text.consensus_value) == 0.0
    assert one(spark, None, text.consensus_value) == 0.0
    assert one(spark, " ", lambda c: text.consensus_value(c, "null")) is None
    assert one(spark, "x", text.consensus_value) is None


@pytest.mark.parametrize(
    "shown, want", [("$12.50 $3.199 $0.5", 3.199), ("$10.00", None), ("$1.0 $1.00 $9.99", 9.99), ("3.5", None)]
)
def test_first_plausible_price(spark, shown, want):
    assert one(spark, shown, text.first_plausible_price) == want


def test_plausible_price_reads_whole_text(spark):
    assert one(spark, "word " * 200_000 + "$2.5", text.first_plausible_price) == 2.5


@pytest.mark.parametrize("shown, want", [("Last Updated:  Aug 1 ", "Aug 1"), ("Last Updated:", "Unknown"), (None, "Unknown")])
def test_clean_label(spark, shown, want):
    assert one(spark, shown, text.clean_label) == want


def test_fuel_type_and_blank_names(spark):
    df = spark.createDataFrame(
        [(RETAIL, " Regular "), (DAILY_AVG, "Regular"), (" NaN ", "x"), ("a", "  "), (None, "x")], "s string, f string"
    )
    got = df.select(text.normal_fuel_type(F.col("s"), F.col("f")), text.is_blank_name(F.col("s")), text.is_blank_name(F.col("f")))
    assert [tuple(r) for r in got.collect()] == [
        ("regular_gas", False, False),
        ("regular", False, False),
        ("x", True, False),
        ("", False, True),
        ("x", True, False),
    ]


@pytest.mark.parametrize("x, want", [(3.125, 3.10), (3.175, 3.20), (3.13, 3.15)])
def test_round_to_05(spark, x, want):
    assert one(spark, x, arith.round_to_05, "double") == pytest.approx(want, abs=1e-12)


def test_jump(spark):
    df = spark.createDataFrame([(3.0, 2.0), (3.0001, 2.0), (5.0, 0.0), (5.0, None)], "n double, p double")
    got = [r[0] for r in df.select(arith.jump(F.col("n"), F.col("p"))).collect()]
    assert got[0] == 0.5 and got[1] > 0.5 and got[2:] == [0.0, 0.0]


def when(spark, source, label, scraped=None):
    df = spark.createDataFrame([(source, label, scraped)], "s string, l string, t string")
    return df.select(clock.event_time(F.col("s"), F.col("l"), F.col("t"))).first()[0]


def test_event_time_by_source(spark):
    assert when(spark, DAILY_AVG, "Current as of 2025-08-24") == datetime(2025, 8, 24, 12)
    assert when(spark, DAILY_AVG, "Current as of 2025-01-24") == datetime(2025, 1, 24, 13)
    assert when(spark, RETAIL, "x", "9/2/2025 12:25:02 AM") == datetime(2025, 9, 2, 4, 25, 2)
    assert when(spark, RETAIL, "x", "soon") is None
    assert when(spark, RBOB, "Sep 2, 2025 4:59 p.m. EDT") == datetime(2025, 9, 2, 20, 59)
    assert when(spark, RBOB, "2025-01-02 10:00:00 EST") == datetime(2025, 1, 2, 15)
    assert when(spark, STOCKS, "2025-08-20") == datetime(2025, 8, 20, 4)
    assert when(spark, "elsewhere", "2025-08-20") is None


def test_skipped_and_doubled_hour(spark):
    assert when(spark, RETAIL, "", "3/10/2024 2:30:00 AM") == datetime(2024, 3, 10, 7, 30)
    assert when(spark, RETAIL, "", "11/3/2024 1:30:00 AM") == datetime(2024, 11, 3, 5, 30)


def test_label_date_shift(spark):
    assert one(spark, "2025-08-20", clock.label_date) == date(2025, 8, 19)
    assert one(spark, "2025-08-20", lambda c: clock.label_date(c, clock.NEW_YORK)) == date(2025, 8, 20)


def test_as_of_date(spark):
    df = spark.createDataFrame([(DAILY_AVG, "as of 2025-08-24"), (RUNS, "2025-08-24"), (DAILY_AVG, "2025-13-24")], "s string, l string")
    got = [r[0] for r in df.select(clock.as_of_from_label(F.col("s"), F.col("l"))).collect()]
    assert got == [date(2025, 8, 24), None, None]
    assert one(spark, datetime(2025, 8, 25, 3), clock.as_of_by_lag, "timestamp_ntz") == date(2025, 8, 23)


@pytest.mark.parametrize(
    "utc, want",
    [
        (datetime(2025, 9, 1, 15, 59), datetime(2025, 8, 25, 12)),
        (datetime(2025, 9, 1, 16, 0), datetime(2025, 9, 1, 12)),
    ],
)
def test_week_anchor(spark, utc, want):
    assert one(spark, utc, clock.week_anchor, "timestamp_ntz") == want


def test_next_sunday_is_strictly_after(spark):
    assert one(spark, date(2025, 9, 7), clock.next_sunday, "date") == date(2025, 9, 14)


@pytest.mark.parametrize(
    "utc, want",
    [
        (datetime(2025, 9, 7, 21, 59), False),
        (datetime(2025, 9, 7, 22, 0), True),
        (datetime(2025, 9, 5, 23, 59), True),
        (datetime(2025, 9, 6, 0, 0), False),
    ],
)
def test_market_open(spark, utc, want):
    assert one(spark, utc, clock.market_open, "timestamp_ntz") is want


def test_display_text(spark):
    assert one(spark, 3.1, text.money, "double") == "$3.100"
    assert one(spark, None, text.money, "double") == "No data"
    assert one(spark, None, text.plain, "double") == "—"
    assert one(spark, 0.123, text.percent, "double") == "12.3%"
    assert one(spark, datetime(2025, 7, 1, 12), clock.zone_text, "timestamp_ntz") == "2025-07-01 08:00 EDT"
    assert one(spark, datetime(2025, 1, 1, 12), clock.zone_text, "timestamp_ntz") == "2025-01-01 07:00 EST"
    assert one(spark, None, clock.zone_text, "timestamp_ntz") == "—"
