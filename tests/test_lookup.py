"""Lookups, de-duplication and the screen on hand-made rows."""

from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from fuelscope.functions.clock import ntz
from fuelscope.operators import daily, lookup
from fuelscope.plans import reports
from fuelscope.schema import DAILY_AVG, RBOB, RETAIL, RUNS, STOCKS, SCREENED

T0 = datetime(2024, 5, 6, 12)
OBS = "seq long, source string, fuel_type string, price double, label_ts string, scraped_at timestamp_ntz, surprise double"


def obs(spark, *rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], OBS)


def test_tie_on_newest_time(spark):
    df = obs(
        spark,
        (RBOB, "f", 2.0, "a", T0, None),
        (RBOB, "f", 2.1, "b", T0, None),
        (RBOB, "f", 1.9, "c", T0 - timedelta(hours=1), None),
        (RBOB, "f", 1.8, "d", T0 - timedelta(hours=2), None),
        (DAILY_AVG, "f", 3.0, "Current as of 2024-05-01", T0 - timedelta(days=5), None),
        (DAILY_AVG, "f", 3.1, "current as of 2024-05-02", T0, None),
    )
    assert {r["seq"] for r in lookup.latest_rows(df, ["source"]).collect()} == {0, 1, 5}
    assert {r["seq"] for r in lookup.previous_rows(df, ["source"]).collect()} == {2, 4}
    assert {r["seq"] for r in lookup.latest_set(df).collect()} == {0, 1, 4}


def test_insert_if_absent(spark):
    stored = obs(spark, (RBOB, "f", 1.0, "", T0, None))
    batch = obs(
        spark,
        (RBOB, "f", 2.0, "", T0, None),
        (RBOB, None, 3.0, "", T0, None),
        (RBOB, None, 4.0, "", T0, None),
        (RBOB, "g", 5.0, "", T0, None),
        (RBOB, "g", 6.0, "", T0, None),
    )
    assert {r["price"] for r in lookup.insert_if_absent(stored, batch).collect()} == {3.0, 4.0, 5.0}
    assert {r["price"] for r in lookup.insert_if_absent(stored.limit(0), batch).collect()} == {2.0, 3.0, 4.0, 5.0}


def test_keep_first_in_order(spark):
    df = obs(spark, *[(RBOB, "f", float(9 - i), "", T0, None) for i in range(3)]).repartition(3)
    assert [r["price"] for r in lookup.keep_first(df, ["source", "fuel_type", "scraped_at"], "seq").collect()] == [9.0]


def test_screen_limits(spark):
    week = T0 - timedelta(days=8)
    stored = obs(
        spark,
        (RETAIL, "f", 2.0, "", T0, None),
        (RBOB, "f", 0.0, "", T0, None),
        (DAILY_AVG, "f", 1.0, "", week, None),
        (DAILY_AVG, "f", 1.4, "", T0, None),
        (STOCKS, "f", 1.0, "", T0, None),
    )
    new = obs(
        spark,
        (RETAIL, "f", 3.0, "", T0, None),
        (RETAIL, "f", 3.0001, "", T0, None),
        (RBOB, "f", 9.0, "", T0, None),
        (DAILY_AVG, "f", 1.6, "", T0, None),
        (STOCKS, "f", 50.0, "", T0, None),
        (RUNS, "f", 50.0, "", T0, None),
    )
    out = lookup.screen_batch(new, stored, ntz(str(T0 + timedelta(hours=1))), ["source"], SCREENED)
    assert [(r["accepted"], r["reason"]) for r in out.orderBy("seq").collect()] == [
        (True, None), (False, "last"), (True, None), (False, "week"), (True, None), (True, None),
    ]


def test_period_averages(spark):
    now = ntz("2024-05-06 16:00:00")  # Monday noon in New York
    df = obs(
        spark,
        (RETAIL, "f", 1.0, "", datetime(2024, 5, 6, 15, 59), None),
        (RETAIL, "f", 3.0, "", datetime(2024, 5, 6, 16, 0), None),
        (RETAIL, "f", 8.0, "", datetime(2024, 5, 2, 12, 0), None),
        (RETAIL, "f", 90.0, "", datetime(2024, 4, 30, 12, 0), None),
    )
    got = {r["period"]: r["value"] for r in daily.period_averages(df, now, []).collect()}
    assert got == {"Daily (EST)": 2.0, "Month-to-Date": 4.0, "Week-to-Date": 3.0}
    none = {r["period"]: r["value"] for r in daily.period_averages(df.limit(0), now, []).collect()}
    assert set(none.values()) == {None} and len(none) == 3


def test_status_table_fills_missing_sources(spark):
    df = obs(
        spark,
        (RETAIL, "f", 3.25, "", T0, None),
        (STOCKS, "f", 1.0, "", T0, -0.5),
        (DAILY_AVG, "f", 3.5, "not now", T0, None),
    )
    got = {r["description"]: (r["last_value"], r["at"]) for r in reports.status_table(spark, df, df).collect()}
    assert got == {
        "GasBuddy": ("$3.250", "2024-05-06 08:00 EDT"),
        "AAA": ("$3.500", "2024-05-06 08:00 EDT"),
        "RBOB Future": ("—", "—"),
        "WTI": ("—", "—"),
        "Gasoline Stocks Change Surprise": ("-0.500", "2024-05-06 08:00 EDT"),
        "Refinery Runs": ("—", "—"),
    }


def test_value_at_or_latest(spark):
    panel = spark.createDataFrame(
        [("a", date(2024, 1, 1), 1.0), ("a", date(2024, 1, 2), None), ("a", date(2024, 1, 3), 3.0)], "k string, date date, v double"
    )
    wanted = spark.createDataFrame([("a", date(2024, 1, 2)), ("a", date(2024, 1, 9)), ("a", date(2024, 1, 1))], "k string, ref date")
    got = {r["ref"].day: r["v"] for r in lookup.value_at_or_latest(panel, wanted, ["k"], "ref", ["v"]).collect()}
    assert got == {1: 1.0, 2: None, 9: 3.0}


def test_crack_series_needs_both_futures(spark):
    from fuelscope.schema import WTI

    df = obs(
        spark,
        (RBOB, "f", 2.0, "", T0, None),
        (WTI, "f", 80.0, "", T0, None),
        (RBOB, "f", 2.0, "", T0 + timedelta(days=2), None),
    )
    assert [r["Crack_Spread"] for r in reports.crack_series(df, []).collect()] == [4.0]
    outer = reports.futures_outer(df, []).orderBy("date").collect()
    assert [(r["RBOB"], r["WTI"]) for r in outer] == [(2.0, 80.0), (None, None), (2.0, None)]


def test_result_does_not_depend_on_partitions(spark, sf_dir):
    from fuelscope.workload.frames import observations

    df = observations(spark, sf_dir)
    a = lookup.latest_rows(df, ["region", "source"])
    b = lookup.latest_rows(df.repartition(7, "seq").orderBy(F.desc("seq")), ["region", "source"])
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_null_keys_are_keys(spark):
    from fuelscope.operators.lookup import latest_rows, previous_rows, screen_batch, value_at_or_latest

    data = [(k, f"2024-01-0{d}", float(d)) for k in (None, "e") for d in (1, 2, 3)]
    df = spark.createDataFrame(data, "region string, t string, price double").selectExpr("region", "cast(t as timestamp_ntz) scraped_at", "price", "'s' source")
    assert sorted(r.price for r in latest_rows(df, ["region"]).collect()) == [3.0, 3.0]
    assert sorted(r.price for r in previous_rows(df, ["region"]).collect()) == [2.0, 2.0]
    now = df.selectExpr("region", "10 * price price", "scraped_at", "source").filter("price = 30")
    from pyspark.sql import functions as F

    out = screen_batch(now, df, F.expr("timestamp_ntz'2024-01-04 00:00:00'"), ["region"], ["s"]).collect()
    assert [r.reason for r in out] == ["last", "last"]
    panel = df.selectExpr("region", "cast(scraped_at as date) date", "price")
    wanted = panel.selectExpr("region", "date_add(date, 5) day").filter("day = '2024-01-08'")
    assert [r.price for r in value_at_or_latest(panel, wanted, ["region"], "day", ["price"]).collect()] == [3.0, 3.0]
