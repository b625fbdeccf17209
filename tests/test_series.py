"""Series functions against pandas, and small hand-made cases."""

from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fuelscope.operators import daily, series

KEYS = ["k"]


def make(seed, n, gaps=0.25, outliers=0.1):
    rng = np.random.default_rng(seed)
    x = 3 + rng.normal(0, 0.1, n).cumsum()
    x[rng.random(n) < outliers] += 5
    x[rng.random(n) < gaps] = np.nan
    return x


CASES = {
    "gappy": make(1, 120),
    "dense": make(2, 150, gaps=0.0),
    "sparse": make(3, 200, gaps=0.8),
    "short": np.array([2.0, np.nan, 3.0]),
    "lead": np.concatenate([[np.nan] * 5, make(4, 30)]),
    "tailgap": np.concatenate([make(5, 20), [np.nan] * 40]),
    "flat": np.full(30, 3.0),
    "none": np.full(6, np.nan),
    "one": np.array([1.0]),
}


@pytest.fixture(scope="module")
def frame(spark):
    start = date(2024, 1, 1)
    rows = [
        (k, start + timedelta(days=i), None if np.isnan(v) else float(v))
        for k, x in CASES.items()
        for i, v in enumerate(x)
    ]
    return spark.createDataFrame(rows, "k string, date date, x double").repartition(3, "date").cache()


def check(df, col, want):
    got = df.select("k", "date", col).toPandas()
    for k, x in CASES.items():
        have = got[got.k == k].sort_values("date")[col].to_numpy("float64")
        np.testing.assert_allclose(have, want(pd.Series(x)).to_numpy("float64"), atol=1e-9, err_msg=k)


def hampel_pandas(s, least):
    med = s.rolling(7, center=True, min_periods=least).median()
    mad = (s - med).abs().rolling(7, center=True, min_periods=least).median()
    return s.where(~((s - med).abs() > 3 * 1.4826 * mad), med)


def test_fill(frame):
    check(series.forward_fill(frame, KEYS, "x"), "x", lambda s: s.ffill())
    check(series.fill_both(frame, KEYS, "x"), "x", lambda s: s.ffill().bfill())


@pytest.mark.parametrize("least", [1, 3])
def test_rolling_median_and_hampel(frame, least):
    check(series.rolling_median(frame, KEYS, "x", "m", 3, least), "m", lambda s: s.rolling(7, center=True, min_periods=least).median())
    check(series.hampel(frame, KEYS, "x", "h", 3, least), "h", lambda s: hampel_pandas(s, least))


@pytest.mark.parametrize("span", [2, 3, 5])
def test_exponential_mean(frame, span):
    check(series.ewm(frame, KEYS, "x", "e", span), "e", lambda s: s.ewm(span=span, adjust=False).mean())


def test_smoothers(frame):
    check(series.robust_smooth(frame, KEYS, "x", "s"), "s", lambda s: hampel_pandas(s, 1).ewm(span=5, adjust=False).mean())
    check(
        series.model_smooth(frame, KEYS, "x", "s"),
        "s",
        lambda s: hampel_pandas(s, 3).ewm(span=3, adjust=False, min_periods=1).mean().ffill().bfill(),
    )


def test_clipped_slope(frame):
    def want(s):
        e = s.ewm(span=2, adjust=False).mean()
        return np.tanh((e - e.shift(7)) / 7 / 0.03) * 0.03

    check(series.clipped_slope(frame, KEYS, "x", "c"), "c", want)


def test_exponential_mean_over_gap(spark):
    rows = [("a", date(2024, 1, i + 1), v) for i, v in enumerate([1.0, None, None, 2.0])]
    df = spark.createDataFrame(rows, "k string, date date, x double")
    got = [r["e"] for r in series.ewm(df, KEYS, "x", "e", 3).orderBy("date").collect()]
    assert got == pytest.approx([1.0, 1.0, 1.0, 1.8])


def test_outlier_on_flat_series_is_repaired(spark):
    values = [3.0] * 4 + [9.0] + [3.0] * 4
    df = spark.createDataFrame([("a", date(2024, 1, i + 1), v) for i, v in enumerate(values)], "k string, date date, x double")
    got = [r["h"] for r in series.hampel(df, KEYS, "x", "h").orderBy("date").collect()]
    assert got == [3.0] * 9


def test_constant_series_stays(frame):
    flat = frame.filter("k = 'flat'")
    for smooth in (series.robust_smooth, series.model_smooth):
        got = [r["s"] for r in smooth(flat, KEYS, "x", "s").collect()]
        assert len(got) == 30 and got == pytest.approx([3.0] * 30, abs=1e-12)


def test_pulse(spark):
    values = [0.0, 10.0, 0.0, None, 0.0, 0.0]
    df = spark.createDataFrame([("a", date(2024, 1, i + 1), v) for i, v in enumerate(values)], "k string, date date, x double")
    out = df.withColumn("p", series.pulse(F.col("x"), KEYS)).orderBy("date")
    assert [r["p"] for r in out.collect()] == pytest.approx([0, 10, 6, 3.6, 2.16, 0])


def test_pulse_projection(spark):
    values = [1.0, 2.0, 3.0, 4.0]
    df = spark.createDataFrame([("a", date(2024, 1, i + 1), v) for i, v in enumerate(values)], "k string, date date, x double")
    got = [r["p"] for r in series.pulse_projection(df, KEYS, "x", "p", 5).orderBy("h").collect()]
    w = [1.0, 0.6, 0.36, 0.216]
    assert got == pytest.approx([w[1] * 4 + w[2] * 3 + w[3] * 2, w[2] * 4 + w[3] * 3, w[3] * 4, 0, 0])


def test_seed_slope(frame):
    got = {r["k"]: r for r in series.seed_slope(frame, KEYS, "x").collect()}
    for k, x in CASES.items():
        s = pd.Series(x).dropna()
        if len(s) == 0:
            assert k not in got
            continue
        assert got[k]["last_value"] == s.iloc[-1]
        assert got[k]["slope0"] == pytest.approx((s.iloc[-1] - s.iloc[-7]) / 7 if len(s) >= 7 else 0.0)


def test_resample_keeps_empty_days(spark):
    from datetime import datetime

    rows = [(1.0, datetime(2024, 1, 1, 12)), (3.0, datetime(2024, 1, 1, 13)), (5.0, datetime(2024, 1, 5, 12))]
    df = spark.createDataFrame(rows, "price double, scraped_at timestamp_ntz")
    got = [(r["date"].day, r["price"]) for r in daily.resample_daily(df, []).orderBy("date").collect()]
    assert got == [(1, 2.0), (2, None), (3, None), (4, None), (5, 5.0)]


def test_trend_line(frame):
    got = {r["k"]: r for r in daily.trend_line(frame, KEYS, 14, "x").collect()}
    for k, x in CASES.items():
        s = pd.Series(x, index=[date(2024, 1, 1) + timedelta(days=i) for i in range(len(x))]).dropna().tail(14)
        if len(s) < 3:
            assert k not in got
            continue
        m, b = np.polyfit([d.toordinal() for d in s.index], s.to_numpy(), 1)
        assert got[k]["slope"] == pytest.approx(m, abs=1e-7)
        last = s.index[-1].toordinal()
        assert got[k]["slope"] * last + got[k]["intercept"] == pytest.approx(m * last + b, abs=1e-5)


def test_sigma_buckets(spark):
    values = [3.0, 3.1, 3.0, 3.4, 3.4]
    df = spark.createDataFrame([("a", date(2024, 1, i + 1), v) for i, v in enumerate(values)], "k string, date date, price double")
    got = {r["k"]: r for r in daily.sigma_buckets(df.withColumnRenamed("k", "key"), ["key"]).collect()}
    diffs = pd.Series(values).diff()
    sigma = diffs.std()
    for k in (3, 2, 1, 0):
        assert got[k]["abs_move"] == pytest.approx(k * sigma)
        assert got[k]["up"] == pytest.approx(3.4 + k * sigma)
        assert got[k]["occurrences"] == int((diffs.abs() >= k * sigma).sum())


def test_sigma_buckets_with_one_day(spark):
    df = spark.createDataFrame([("a", date(2024, 1, 1), 3.0)], "key string, date date, price double")
    assert {(r["k"], r["abs_move"], r["occurrences"]) for r in daily.sigma_buckets(df, ["key"]).collect()} == {
        (k, None, 0) for k in (3, 2, 1, 0)
    }
