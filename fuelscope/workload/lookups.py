"""Joins, lookups and raw aggregates (D, E, F1)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..functions import clock
from ..operators import coverage as cov
from ..operators import daily, lookup
from ..plans import reports
from ..schema import DAILY_AVG, RBOB, RETAIL, WTI
from .frames import NOW, OBS, now, ny, observations, table
from .registry import bigint, query, rounded

HOURLY = f"{OBS}, t AS (SELECT * REPLACE (date_trunc('hour', scraped_at) AS scraped_at) FROM obs)"


def hourly(spark, d):
    """Observations with ties: times cut to the hour."""
    hour = F.date_trunc("hour", "scraped_at").cast("timestamp_ntz")
    return observations(spark, d).withColumn("scraped_at", hour)


LONG = f"""days AS (SELECT source, CASE WHEN source = '{DAILY_AVG}' THEN day - 1 ELSE day END AS date, avg(price) AS v
    FROM obs WHERE source IN ('{RETAIL}', '{DAILY_AVG}', '{RBOB}', '{WTI}') GROUP BY ALL)"""


@query(
    "d1_spine_join",
    f"""WITH {OBS}, {LONG}, s AS (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM days)
        SELECT s.date, round(max(CASE WHEN source = '{RETAIL}' THEN v END), 8) AS gb, round(max(CASE WHEN source = '{DAILY_AVG}' THEN v END), 8) AS aaa,
            round(max(CASE WHEN source = '{RBOB}' THEN v END), 8) AS rbob, round(max(CASE WHEN source = '{WTI}' THEN v END), 8) AS wti
        FROM s LEFT JOIN days USING (date) GROUP BY s.date""",
)
def _(spark, d):
    df = observations(spark, d).filter(F.col("source").isin(RETAIL, DAILY_AVG, RBOB, WTI))
    day = clock.ny_date(F.col("scraped_at"))
    day = F.when(F.col("source") == DAILY_AVG, F.date_sub(day, 1)).otherwise(day)
    names = {RETAIL: "gb", DAILY_AVG: "aaa", RBOB: "rbob", WTI: "wti"}
    wide = df.groupBy(day.alias("date")).agg(
        *[F.avg(F.when(F.col("source") == s, F.col("price"))).alias(n) for s, n in names.items()]
    )
    return rounded(daily.densify(wide, []), 8)


GAPPED = "g AS (SELECT * FROM obs WHERE dayofmonth(day) % 7 <> 0)"


def gapped(spark, d):
    """Observations without the New York days whose number divides by seven."""
    df = observations(spark, d)
    return df.filter(F.dayofmonth(clock.ny_date(F.col("scraped_at"))) % 7 != 0)


@query(
    "d2_full_outer",
    f"""WITH {OBS}, r AS (SELECT day AS date, avg(price) AS RBOB FROM obs WHERE source = '{RBOB}' AND price > 120 GROUP BY 1),
        w AS (SELECT day AS date, avg(price) AS WTI FROM obs WHERE source = '{WTI}' AND price > 120 GROUP BY 1),
        rs AS (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM r),
        ws AS (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM w)
        SELECT coalesce(rs.date, ws.date) AS date, round(RBOB, 8) AS RBOB, round(WTI, 8) AS WTI
        FROM (rs LEFT JOIN r USING (date)) rs FULL JOIN (ws LEFT JOIN w USING (date)) ws ON rs.date = ws.date""",
)
def _(spark, d):
    return rounded(reports.futures_outer(observations(spark, d).filter("price > 120"), []), 8)


@query(
    "d3_latest_per_source",
    f"""WITH {HOURLY} SELECT seq, source, price, scraped_at FROM t
        WHERE scraped_at = (SELECT max(scraped_at) FROM t p WHERE p.source = t.source)""",
)
def _(spark, d):
    return lookup.latest_rows(hourly(spark, d).select("seq", "source", "price", "scraped_at"), ["source"])


ASOF = """ASOF LEFT JOIN (SELECT {k}, scraped_at AS at, arg_max(price, seq) AS p FROM obs GROUP BY ALL) h
    ON {on} AND o.scraped_at - INTERVAL 7 DAY >= h.at"""


@query(
    "d4_as_of_7_days",
    f"WITH {OBS} SELECT o.seq, o.source, o.price, h.p AS week_price FROM obs o "
    + ASOF.format(k="source", on="o.source = h.source"),
)
def _(spark, d):
    df = observations(spark, d).select("seq", "source", "price", "scraped_at")
    return lookup.asof(df, df, ["source"], "price", "week_price", "7 days").drop("scraped_at")


@query(
    "d4_as_of_by_region",
    f"WITH {OBS} SELECT o.seq, o.region, o.source, h.p AS week_price FROM obs o "
    + ASOF.format(k="region, source", on="o.region = h.region AND o.source = h.source"),
)
def _(spark, d):
    df = observations(spark, d).select("seq", "region", "source", "price", "scraped_at")
    out = lookup.asof(df, df, ["region", "source"], "price", "week_price", "7 days")
    return out.select("seq", "region", "source", "week_price")


@query("d5_last_price", f"WITH {OBS} SELECT source, arg_max(price, scraped_at) AS price, max(scraped_at) AS scraped_at FROM obs GROUP BY source")
def _(spark, d):
    return lookup.latest_value(observations(spark, d), ["source"])


@query(
    "d6_value_at_or_latest",
    f"""WITH {OBS}, p AS (SELECT source, day AS date, avg(price) AS price FROM obs GROUP BY ALL),
        l AS (SELECT source, max(date) AS last, arg_max(price, date) AS lp FROM p GROUP BY source),
        w AS (SELECT source, last, lp, h, last + h AS day FROM l, (SELECT CAST(unnest(range(1, 15)) AS INTEGER) AS h))
        SELECT w.source, CAST(h AS BIGINT) AS h, w.day - 7 AS ref, round(coalesce(p.price, lp), 8) AS price
        FROM w LEFT JOIN p ON p.source = w.source AND p.date = w.day - 7""",
)
def _(spark, d):
    panel = daily.daily_mean(observations(spark, d), ["source"], clock.ny_date(F.col("scraped_at")))
    last = panel.groupBy("source").agg(F.max("date").alias("last"))
    ahead = last.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(14))))
    wanted = ahead.select("source", bigint(F.col("h")).alias("h"), F.date_sub(F.date_add("last", F.col("h")), 7).alias("ref"))
    return rounded(lookup.value_at_or_latest(panel, wanted, ["source"], "ref", ["price"]), 8)


@query(
    "d7_anti_join",
    """SELECT event_id, event_type, user_id FROM events e WHERE NOT EXISTS
        (SELECT 1 FROM events p WHERE p.event_type = 'purchase' AND p.user_id = e.user_id AND CAST(p.ts AS DATE) = CAST(e.ts AS DATE))""",
)
def _(spark, d):
    events = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    bought = events.filter("event_type = 'purchase'").select("user_id", "day")
    return events.join(bought, ["user_id", "day"], "left_anti").select("event_id", "event_type", "user_id")


@query(
    "d8_latest_with_fallback",
    f"""WITH {OBS}, l AS (SELECT *, 1 AS rank FROM obs WHERE price > 250 UNION ALL SELECT *, 0 FROM obs)
        SELECT region, source, price, scraped_at FROM l
        QUALIFY row_number() OVER (PARTITION BY region, source ORDER BY rank DESC, scraped_at DESC, seq DESC) = 1""",
)
def _(spark, d):
    df = observations(spark, d)
    return lookup.latest_with_fallback(df.filter("price > 250"), df, ["region", "source"], ["price"])


@query("e1_daily_mean", f"WITH {OBS} SELECT source, day AS date, round(avg(price), 8) AS price FROM obs GROUP BY ALL")
def _(spark, d):
    return rounded(daily.daily_mean(observations(spark, d), ["source"], clock.ny_date(F.col("scraped_at"))), 8)


@query("e2_daily_mean_as_of", f"WITH {OBS} SELECT source, day - 1 AS date, round(avg(price), 8) AS price FROM obs GROUP BY ALL")
def _(spark, d):
    return rounded(daily.daily_mean(observations(spark, d), ["source"], clock.as_of_by_lag(F.col("scraped_at"))), 8)


@query(
    "e3_daily_resample",
    f"""WITH {OBS}, {GAPPED}, m AS (SELECT source, day AS date, avg(price) AS price FROM g GROUP BY ALL),
        s AS (SELECT source, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM m GROUP BY source)
        SELECT s.source, s.date, round(price, 8) AS price FROM s LEFT JOIN m USING (source, date)""",
)
def _(spark, d):
    return rounded(daily.resample_daily(gapped(spark, d), ["source"]), 8)


ANCHOR = f"""n AS (SELECT {ny(f"TIMESTAMP '{NOW}'")} AS w),
    a AS (SELECT w, CAST(w AS DATE) AS today, CASE WHEN w < date_trunc('week', w) + INTERVAL 12 HOUR
        THEN date_trunc('week', w) + INTERVAL 12 HOUR - INTERVAL 7 DAY ELSE date_trunc('week', w) + INTERVAL 12 HOUR END AS anchor FROM n)"""


@query(
    "e4_period_averages",
    f"""WITH {OBS}, {ANCHOR}, m AS (SELECT source, avg(price) FILTER (day = today) AS d, avg(price) FILTER (day >= date_trunc('month', today)) AS m,
            avg(price) FILTER (wall >= anchor) AS w FROM obs, a GROUP BY source)
        SELECT source, 'Daily (EST)' AS period, round(d, 8) AS value FROM m UNION ALL SELECT source, 'Month-to-Date', round(m, 8) FROM m
        UNION ALL SELECT source, 'Week-to-Date', round(w, 8) FROM m""",
)
def _(spark, d):
    return rounded(daily.period_averages(observations(spark, d), now(), ["source"]), 8)


@query("e5_row_count", "SELECT count(*) AS n FROM events")
def _(spark, d):
    return observations(spark, d).agg(F.count(F.lit(1)).alias("n"))


@query("e6_count_by_source", f"WITH {OBS} SELECT source, count(*) AS n FROM obs GROUP BY source ORDER BY n DESC, source")
def _(spark, d):
    return daily.count_by_source(observations(spark, d))


@query("e7_date_range", f"WITH {OBS} SELECT min(scraped_at) AS earliest, max(scraped_at) AS latest FROM obs")
def _(spark, d):
    return daily.date_range(observations(spark, d))


MOVES = f"""m AS (SELECT region, source, day - 1 AS date, avg(price) AS price FROM obs GROUP BY ALL),
    f AS (SELECT *, price - lag(price) OVER (PARTITION BY region, source ORDER BY date) AS diff FROM m)"""


def as_of_days(spark, d):
    return daily.daily_mean(observations(spark, d), ["region", "source"], clock.as_of_by_lag(F.col("scraped_at")))


@query(
    "e8_move_sigma",
    f"WITH {OBS}, {MOVES} SELECT region, source, round(stddev_samp(diff), 6) AS sigma, round(arg_max(price, date), 6) AS last_value FROM f GROUP BY ALL",
)
def _(spark, d):
    return rounded(daily.move_sigma(as_of_days(spark, d), ["region", "source"]))


@query(
    "e9_sigma_buckets",
    f"""WITH {OBS}, m AS (SELECT source, day - 1 AS date, avg(price) AS price FROM obs GROUP BY ALL),
        f AS (SELECT *, price - lag(price) OVER (PARTITION BY source ORDER BY date) AS diff FROM m),
        s AS (SELECT source, stddev_samp(diff) AS sigma, arg_max(price, date) AS last FROM f GROUP BY source)
        SELECT s.source, CAST(k AS BIGINT) AS k, round(k * sigma, 6) AS abs_move, round(last + k * sigma, 6) AS up, round(last - k * sigma, 6) AS down,
            (SELECT count(diff) FROM f WHERE f.source = s.source AND (k = 0 OR abs(diff) >= k * sigma)) AS occurrences
        FROM s, (SELECT unnest([3, 2, 1, 0]) AS k)""",
)
def _(spark, d):
    days = daily.daily_mean(observations(spark, d), ["source"], clock.as_of_by_lag(F.col("scraped_at")))
    return rounded(daily.sigma_buckets(days, ["source"])).withColumn("k", bigint(F.col("k")))


@query(
    "e10_percentiles",
    f"""WITH {OBS} SELECT source, round(avg(price), 6) AS mean, round(quantile_cont(price, 0.05), 6) AS p05,
        round(quantile_cont(price, 0.95), 6) AS p95 FROM obs GROUP BY source""",
)
def _(spark, d):
    return rounded(daily.percentiles(observations(spark, d), ["source"], "price", {"p05": 0.05, "p95": 0.95}))


@query("e11_exceedance", f"WITH {OBS} SELECT source, round(avg(CASE WHEN price > 75 THEN 1.0 ELSE 0.0 END), 8) AS probability FROM obs GROUP BY source")
def _(spark, d):
    return rounded(daily.exceedance(observations(spark, d), ["source"], "price", F.lit(75.0)), 8)


@query(
    "e12_trend_line",
    f"""WITH {OBS}, m AS (SELECT source, day - 1 AS date, avg(price) AS price FROM obs GROUP BY ALL),
        l AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY source ORDER BY date DESC) <= 14),
        x AS (SELECT *, date_diff('day', max(date) OVER (PARTITION BY source), date) AS x FROM l)
        SELECT source, count(*) AS points, round(regr_slope(price, x), 6) AS slope, round(regr_intercept(price, x), 6) AS at_last FROM x GROUP BY source HAVING count(*) >= 3""",
)
def _(spark, d):
    days = daily.daily_mean(observations(spark, d), ["source"], clock.as_of_by_lag(F.col("scraped_at")))
    return rounded(daily.trend_line(days, ["source"]).select("source", "points", "slope", "at_last"))


@query(
    "e15_previous_sunday",
    f"""WITH {OBS}, m AS (SELECT region, source, day - 1 AS sunday, avg(price) AS value FROM obs WHERE isodow(day - 1) = 7 GROUP BY ALL)
        SELECT region, source, sunday, round(value, 8) AS value FROM m QUALIFY row_number() OVER (PARTITION BY region, source ORDER BY sunday DESC) = 1""",
)
def _(spark, d):
    return rounded(daily.previous_sunday(observations(spark, d), ["region", "source"]), 8)


@query(
    "e16_previous_rows",
    f"""WITH {HOURLY} SELECT seq, source, price, scraped_at FROM t
        QUALIFY dense_rank() OVER (PARTITION BY source ORDER BY scraped_at DESC) = 2""",
)
def _(spark, d):
    return lookup.previous_rows(hourly(spark, d).select("seq", "source", "price", "scraped_at"), ["source"])


def _slot_sql() -> str:
    rows = []
    for source, rules in cov.SLOTS.items():
        for days, minutes in rules:
            for day in days:
                rows += [f"('{source}', {day}, {m}, {cov.WIDTH_MINUTES[source]})" for m in minutes]
    return "slots(source, wd, minute, width) AS (SELECT DISTINCT * FROM (VALUES " + ", ".join(rows) + "))"


@query(
    "e17_coverage",
    f"""WITH {OBS}, {_slot_sql()}, days AS (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS date),
        want AS (SELECT * FROM days JOIN slots ON isodow(date) - 1 = wd),
        got AS (SELECT DISTINCT w.source, w.date, w.minute FROM want w JOIN obs o ON o.source = w.source
            AND o.scraped_at >= w.date + to_minutes(w.minute) AND o.scraped_at < w.date + to_minutes(w.minute + w.width)
            AND CAST(o.scraped_at AS DATE) = w.date)
        SELECT w.source, w.date, count(*) AS expected, count(g.minute) AS filled, count(*) - count(g.minute) AS missing,
            round(count(g.minute) / count(*), 8) AS ratio
        FROM want w LEFT JOIN got g USING (source, date, minute) GROUP BY ALL""",
)
def _(spark, d):
    df = observations(spark, d)
    return rounded(cov.coverage(df, datetime(2024, 1, 1), datetime(2024, 1, 30), cov.slot_table(spark)), 8)


@query(
    "f1_latest_set",
    f"""WITH {HOURLY} SELECT seq, source, price, label_ts, scraped_at FROM t
        WHERE (source <> '{DAILY_AVG}' AND scraped_at = (SELECT max(scraped_at) FROM t p WHERE p.source = t.source))
        OR (source = '{DAILY_AVG}' AND label_ts LIKE '%Current%')""",
)
def _(spark, d):
    return lookup.latest_set(hourly(spark, d).select("seq", "source", "price", "label_ts", "scraped_at"))
