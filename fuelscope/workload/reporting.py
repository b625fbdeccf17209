"""Dashboard tables (I12, I13, I16, I17, B21)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clock
from ..operators import daily
from ..plans import model, reports
from ..schema import DAILY_AVG, RBOB, RETAIL, STOCKS, WTI
from ..plans.panel import daily_panel
from . import modelling
from .frames import NOW, OBS, now, ny, observations, order_observations
from .lookups import ANCHOR, HOURLY, hourly
from .registry import query, rounded

CRACK = f"""r AS (SELECT day AS date, avg(price) AS RBOB FROM obs WHERE source = '{RBOB}' GROUP BY 1),
    w AS (SELECT day AS date, avg(price) AS WTI FROM obs WHERE source = '{WTI}' GROUP BY 1),
    crack AS (SELECT date, RBOB, WTI, 42 * RBOB - WTI AS Crack_Spread FROM r JOIN w USING (date))"""


@query(
    "b21_priority_coalesce",
    f"""WITH {OBS} SELECT region, day AS date, round(coalesce(avg(price) FILTER (source = '{DAILY_AVG}'), avg(price) FILTER (source = '{RETAIL}')), 8) AS price
        FROM obs GROUP BY ALL""",
)
def _(spark, d):
    day = clock.ny_date(F.col("scraped_at")).alias("date")
    price = [F.avg(F.when(F.col("source") == s, F.col("price"))) for s in (DAILY_AVG, RETAIL)]
    return rounded(observations(spark, d).groupBy("region", day).agg(F.coalesce(*price).alias("price")), 8)


@query(
    "i12_crack_spread",
    f"WITH {OBS}, {CRACK} SELECT date, round(RBOB, 6) AS RBOB, round(WTI, 6) AS WTI, round(Crack_Spread, 6) AS Crack_Spread FROM crack",
)
def _(spark, d):
    return rounded(reports.crack_series(observations(spark, d), []))


@query(
    "i12_crack_averages",
    f"""WITH {OBS}, {ANCHOR}, {CRACK}, m AS (SELECT avg(Crack_Spread) FILTER (date = today) AS d, avg(Crack_Spread) FILTER (date >= date_trunc('month', today)) AS m,
            avg(Crack_Spread) FILTER (CAST(date AS TIMESTAMP) >= anchor) AS w FROM crack, a)
        SELECT 'Daily (EST)' AS period, round(d, 6) AS value FROM m UNION ALL SELECT 'Month-to-Date', round(m, 6) FROM m UNION ALL SELECT 'Week-to-Date', round(w, 6) FROM m""",
)
def _(spark, d):
    spread = reports.spread_as_observations(reports.crack_series(observations(spark, d), []))
    return rounded(daily.period_averages(spread, now(), []))


@query(
    "i13_status_table",
    f"""WITH {HOURLY}, l AS (SELECT source, arg_max(price, seq) AS price, arg_max(surprise, seq) AS surprise, max(scraped_at) AS at FROM t
            WHERE scraped_at = (SELECT max(scraped_at) FROM t p WHERE p.source = t.source) GROUP BY source),
        n(place, description, source, money) AS (VALUES {", ".join(f"({p}, '{t}', '{s}', {str(m).lower()})" for p, t, s, m in reports.STATUS_ROWS)})
        SELECT place, description, CASE WHEN money THEN '$' || printf('%.3f', price) WHEN n.source = '{STOCKS}' THEN printf('%.3f', coalesce(surprise, price))
            ELSE printf('%.3f', price) END AS last_value, strftime({ny('at')}, '%Y-%m-%d %H:%M') || ' EST' AS at
        FROM n LEFT JOIN l ON l.source = n.source""".replace("max(scraped_at) AS at FROM t", "max(scraped_at) AS t0 FROM t").replace(ny("at"), ny("t0")),
)
def _(spark, d):
    df = hourly(spark, d)
    return reports.status_table(spark, df, df)


@query(
    "i16_retail_month",
    f"WITH {OBS} SELECT seq, price, wall FROM obs WHERE source = '{RETAIL}' AND day >= DATE '2024-01-01' AND day <= DATE '2024-01-20'",
)
def _(spark, d):
    rows = reports.retail_month(observations(spark, d), F.to_date(F.lit("2024-01-20")))
    return rows.select("seq", "price", clock.to_new_york(F.col("scraped_at")).alias("wall"))


@query(
    "i16_average_30_days",
    f"WITH {OBS} SELECT seq, price, day - 1 AS as_of_date FROM obs WHERE source = '{DAILY_AVG}' AND day - 1 >= DATE '2023-12-31' AND day - 1 <= DATE '2024-01-30'",
)
def _(spark, d):
    return reports.average_30_days(observations(spark, d), now()).select("seq", "price", "as_of_date")


@query(
    "i16_future_30_days",
    f"""WITH {OBS} SELECT day AS date, round(avg(price), 8) AS price FROM obs WHERE source = '{RBOB}'
        AND scraped_at >= TIMESTAMP '{NOW}' - INTERVAL 30 DAY GROUP BY day""",
)
def _(spark, d):
    return rounded(reports.future_30_days(observations(spark, d), RBOB, now(), []), 8)


@query(
    "i16_average_last_14",
    f"""WITH {OBS} SELECT region, day - 1 AS date, round(avg(price), 6) AS aaa FROM obs WHERE source = '{DAILY_AVG}' GROUP BY region, day
        QUALIFY row_number() OVER (PARTITION BY region ORDER BY day DESC) <= 14""",
)
def _(spark, d):
    return rounded(reports.last_14(daily_panel(observations(spark, d)), ["region"]))


@query(
    "i17_kpis",
    f"""{modelling.SUNDAY}, k AS (SELECT region, count(*) AS records,
            arg_max(price, (scraped_at, seq)) FILTER (source = '{RETAIL}') AS retail FROM ord GROUP BY region)
        SELECT k.region, records, round(retail, 6) AS retail, round(next_sunday_point, 5) AS next_sunday_point, round(probability, 8) AS probability
        FROM k LEFT JOIN prob USING (region)""",
)
def _(spark, d):
    df = order_observations(spark, d)
    done = model.nowcast(df, ["region"])
    out = reports.kpis(df, done.points, model.sunday_probability(df, done, ["region"]), ["region"])
    return rounded(rounded(rounded(out, 8, "probability"), 6, "retail"), 5, "next_sunday_point")
