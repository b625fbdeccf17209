"""Ordered-series functions over daily means by region and source (F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import daily, series
from .frames import OBS, observations
from .registry import NUDGE, bigint, query, rounded

KEYS = ["region", "source"]
BY = "PARTITION BY region, source ORDER BY date"
PAST = f"OVER ({BY} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
AHEAD = f"OVER ({BY} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
WEEK = f"OVER ({BY} ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)"

DENSE = f"""{OBS}, dm AS (SELECT region, source, day AS date, avg(price) AS x FROM obs GROUP BY ALL),
    sp AS (SELECT region, source, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM dm GROUP BY region, source),
    dense AS (SELECT sp.region, sp.source, sp.date, x FROM sp LEFT JOIN dm USING (region, source, date))"""


def dense(spark, d):
    return daily.resample_daily(observations(spark, d), KEYS, out="x")


def hampel_sql(least: int, name: str = "ham") -> str:
    return f"""{name}1 AS (SELECT *, CASE WHEN count(x) {WEEK} >= {least} THEN median(x) {WEEK} END AS med FROM dense),
    {name}2 AS (SELECT *, abs(x - med) AS dev FROM {name}1),
    {name}3 AS (SELECT *, CASE WHEN count(dev) {WEEK} >= {least} THEN median(dev) {WEEK} END AS mad FROM {name}2),
    {name} AS (SELECT region, source, date, CASE WHEN dev > 3.0 * 1.4826 * mad THEN med ELSE x END AS x FROM {name}3)"""


def ewm_sql(source: str, span: int, name: str = "ew") -> str:
    a = 2.0 / (span + 1)
    return f"""{name}n AS (SELECT *, row_number() OVER ({BY}) AS i FROM {source}),
    {name} AS (SELECT region, source, date, i, x AS y, CAST(1.0 AS DOUBLE) AS w FROM {name}n WHERE i = 1
        UNION ALL SELECT n.region, n.source, n.date, n.i,
            CASE WHEN n.x IS NULL THEN p.y WHEN p.y IS NULL THEN n.x ELSE (p.w * {1 - a!r} * p.y + {a!r} * n.x) / (p.w * {1 - a!r} + {a!r}) END,
            CASE WHEN n.x IS NULL THEN p.w * {1 - a!r} ELSE CAST(1.0 AS DOUBLE) END
        FROM {name} p JOIN {name}n n ON n.region = p.region AND n.source = p.source AND n.i = p.i + 1)"""


@query("f2_forward_fill", f"WITH {DENSE} SELECT region, source, date, round(last_value(x IGNORE NULLS) {PAST}, 6) AS x FROM dense")
def _(spark, d):
    return rounded(series.forward_fill(dense(spark, d), KEYS, "x"))


@query(
    "f3_fill_both",
    f"""WITH {DENSE}, hole AS (SELECT * REPLACE (CASE WHEN dayofmonth(date) > 9 THEN x END AS x) FROM dense)
        SELECT region, source, date, round(coalesce(last_value(x IGNORE NULLS) {PAST}, first_value(x IGNORE NULLS) {AHEAD}), 6) AS x FROM hole""",
)
def _(spark, d):
    hole = dense(spark, d).withColumn("x", F.when(F.dayofmonth("date") > 9, F.col("x")))
    return rounded(series.fill_both(hole, KEYS, "x"))


@query(
    "f4_shift_and_diff",
    f"""WITH {DENSE} SELECT region, source, date, round(lag(x, 1) OVER ({BY}), 6) AS l1, round(lag(x, 7) OVER ({BY}), 6) AS l7,
        round(x - lag(x, 1) OVER ({BY}), 6) AS diff FROM dense""",
)
def _(spark, d):
    x = F.col("x")
    out = dense(spark, d).select(
        *KEYS,
        "date",
        series.shift(x, KEYS, 1).alias("l1"),
        series.shift(x, KEYS, 7).alias("l7"),
        (x - series.shift(x, KEYS, 1)).alias("diff"),
    )
    return rounded(out)


@query("f5_rolling_median", f"WITH {DENSE} SELECT region, source, date, round(CASE WHEN count(x) {WEEK} >= 3 THEN median(x) {WEEK} END, 6) AS med FROM dense")
def _(spark, d):
    return rounded(series.rolling_median(dense(spark, d), KEYS, "x", "med").drop("x"))


@query("f6_hampel", f"WITH {DENSE}, {hampel_sql(3)} SELECT region, source, date, round(x, 6) AS fixed FROM ham")
def _(spark, d):
    return rounded(series.hampel(dense(spark, d), KEYS, "x", "fixed").drop("x"))


@query("f7_hampel_always", f"WITH {DENSE}, {hampel_sql(1)} SELECT region, source, date, round(x, 6) AS fixed FROM ham")
def _(spark, d):
    return rounded(series.hampel(dense(spark, d), KEYS, "x", "fixed", least=1).drop("x"))


@query(
    "f8_exponential_mean",
    f"""WITH RECURSIVE {DENSE}, {ewm_sql('dense', 2, 'e2')}, {ewm_sql('dense', 3, 'e3')}, {ewm_sql('dense', 5, 'e5')}
        SELECT e2.region, e2.source, e2.date, round(e2.y + {NUDGE}, 6) AS s2, round(e3.y + {NUDGE}, 6) AS s3, round(e5.y + {NUDGE}, 6) AS s5
        FROM e2 JOIN e3 USING (region, source, date) JOIN e5 USING (region, source, date)""",
)
def _(spark, d):
    df = dense(spark, d)
    for span in (2, 3, 5):
        df = series.ewm(df, KEYS, "x", f"s{span}", span)
    return rounded(df.drop("x"), nudge=NUDGE)


@query(
    "f9_robust_smooth",
    f"WITH RECURSIVE {DENSE}, {hampel_sql(1)}, {ewm_sql('ham', 5)} SELECT region, source, date, round(y + {NUDGE}, 6) AS smooth FROM ew",
)
def _(spark, d):
    return rounded(series.robust_smooth(dense(spark, d), KEYS, "x", "smooth").drop("x"), nudge=NUDGE)


@query(
    "f9_model_smooth",
    f"""WITH RECURSIVE {DENSE}, {hampel_sql(3)}, {ewm_sql('ham', 3)}
        SELECT region, source, date, round(coalesce(y, first_value(y IGNORE NULLS) {AHEAD}) + {NUDGE}, 6) AS smooth FROM ew""",
)
def _(spark, d):
    return rounded(series.model_smooth(dense(spark, d), KEYS, "x", "smooth").drop("x"), nudge=NUDGE)


@query(
    "f10_pulse",
    f"""WITH {DENSE} SELECT region, source, date, round(coalesce(x, 0) + 0.6 * coalesce(lag(x, 1) OVER ({BY}), 0)
        + 0.36 * coalesce(lag(x, 2) OVER ({BY}), 0) + 0.216 * coalesce(lag(x, 3) OVER ({BY}), 0), 6) AS pulse FROM dense""",
)
def _(spark, d):
    return rounded(dense(spark, d).select(*KEYS, "date", series.pulse(F.col("x"), KEYS).alias("pulse")))


@query(
    "f11_pulse_projection",
    f"""WITH {DENSE}, t AS (SELECT *, row_number() OVER (PARTITION BY region, source ORDER BY date DESC) - 1 AS back,
            max(date) OVER (PARTITION BY region, source) AS last FROM dense),
        w AS (SELECT unnest([1.0, 0.6, 0.36, 0.216]) AS weight, unnest([0, 1, 2, 3]) AS at), h AS (SELECT CAST(unnest(range(1, 8)) AS INTEGER) AS h),
        g AS (SELECT DISTINCT region, source, last, h FROM t, h)
        SELECT g.region, g.source, CAST(g.h AS BIGINT) AS h, g.last + g.h AS date, round(coalesce(sum(w.weight * coalesce(t.x, 0)), 0), 6) AS pulse
        FROM g LEFT JOIN w ON w.at >= g.h LEFT JOIN t ON t.region = g.region AND t.source = g.source AND t.back = w.at - g.h GROUP BY ALL""",
)
def _(spark, d):
    out = series.pulse_projection(dense(spark, d), KEYS, "x", "pulse", 7)
    return rounded(out).withColumn("h", bigint(F.col("h")))


@query(
    "f13_last_14",
    f"""WITH {DENSE} SELECT region, source, date, round(x, 6) AS x FROM dense WHERE x IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY region, source ORDER BY date DESC) <= 14""",
)
def _(spark, d):
    return rounded(daily.last_n(dense(spark, d), KEYS, 14, "x"))


@query(
    "f14_seed_slope",
    f"""WITH {DENSE}, r AS (SELECT *, row_number() OVER (PARTITION BY region, source ORDER BY date DESC) AS rn FROM dense WHERE x IS NOT NULL)
        SELECT region, source, round(max(x) FILTER (rn = 1), 6) AS last_value,
            round(coalesce((max(x) FILTER (rn = 1) - max(x) FILTER (rn = 7)) / 7.0, 0), 6) AS slope0 FROM r GROUP BY ALL""",
)
def _(spark, d):
    return rounded(series.seed_slope(dense(spark, d), KEYS, "x"))


@query(
    "f15_clipped_slope",
    f"""WITH RECURSIVE {DENSE}, {ewm_sql('dense', 2)} SELECT region, source, date,
        round(tanh((y - lag(y, 7) OVER ({BY})) / 7.0 / 0.03) * 0.03, 6) AS slope FROM ew""",
)
def _(spark, d):
    return rounded(series.clipped_slope(dense(spark, d), KEYS, "x", "slope").drop("x"))
