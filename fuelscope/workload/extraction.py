"""Records out of pages (C). Tables in HTML are written from events, one page per
event, so their content is known; the real pages serve the selector query."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.clock import ntz
from ..functions.text import dollar_price
from ..operators import extract
from ..plans.collect import collect
from ..schema import DAILY_AVG, RBOB, RETAIL, RUNS, STOCKS, WTI, as_double
from ..session import new_folder
from ..sources import sinks
from .frames import OBS, now, ny, observations, source_of_event, table
from .registry import query, rounded
from .screening import NAMES, jump_sql

K = "CAST(regexp_extract(props, '[0-9]+') AS DOUBLE)"


def events(spark, d):
    """Pages are many times as large as the events they are written from, whose files make
    few tasks; the events are spread before that."""
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("double")
    spread = table(spark, d, "events").repartition(4 * spark.sparkContext.defaultParallelism, "event_id")
    return spread.withColumn("k", k).withColumn("v", F.format_string("%.2f", "value"))


def tr(*cells, actual: int | None = None):
    parts = [F.lit("<tr>")]
    for i, c in enumerate(cells):
        parts += [F.lit('<td id="actual">' if i == actual else "<td>"), F.lit(c) if isinstance(c, str) else c, F.lit("</td>")]
    return F.concat(*parts, F.lit("</tr>"))


def page(*rows):
    return F.concat(F.lit("<html><body><table><tbody>"), *rows, F.lit("</tbody></table></body></html>"))


@query(
    "c1_table_rows",
    """SELECT event_id, 0 AS row_idx, printf('%.2f', value) AS c0, event_type AS c1, 2 AS width FROM events
       UNION ALL SELECT event_id, 1, 'a & b', '', 3 FROM events""",
)
def _(spark, d):
    html = page(tr(F.col("v"), F.concat(F.lit(" <b>"), F.col("event_type"), F.lit("</b> "))), tr("a &amp; b", "", "x"))
    rows = extract.explode_rows(events(spark, d).select("event_id", html.alias("html")))
    cell = [F.get("cells", F.lit(i)) for i in range(2)]
    width = F.size("cells").alias("width")
    return rows.select("event_id", "row_idx", cell[0].alias("c0"), cell[1].alias("c1"), width)


@query("c2_labelled_price", "SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS price FROM events")
def _(spark, d):
    label = F.when(F.col("event_type") == "error", "Month Ago Avg.").otherwise(" Current Avg. ")
    html = page(
        tr("Yesterday Avg.", "$1.234"), tr("Current Avg."), tr(label, F.concat(F.lit("$"), "v")), tr("Current Avg. again", "$9.999")
    )
    html = F.when(F.col("event_type") == "error", page(tr("Yesterday Avg.", "$1.234"), tr(label, F.col("v")))).otherwise(html)
    found = extract.labelled_price(events(spark, d).select("event_id", html.alias("html")))
    return found.select("event_id", dollar_price(F.col("price_text")).alias("price"))


def plain_sql(x: str) -> str:
    for entity, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("nbsp", " "), ("amp", "&")):
        x = f"regexp_replace({x}, '&{entity};?', '{char}', 'g')"
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


@query(
    "c3_selector_priority",
    f"""SELECT page_id, nullif({plain_sql("regexp_extract(html, '<h1[^>]*>(.*?)</h1>', 1)")}, '') AS price_text,
        coalesce(nullif({plain_sql("regexp_extract(html, '<title>(.*?)</title>', 1)")}, ''), 'Unknown') AS label FROM pages""",
)
def _(spark, d):
    pages = table(spark, d, "pages").select("page_id", "html")
    found = extract.quote(pages, ["h2.intraday__price .value", ".price", "h1"], [".timestamp", "title"])
    return found


def release_page():
    day = F.date_format("ts", "yyyy-MM-dd")
    older = F.date_format(F.date_sub("ts", 7), "yyyy-MM-dd")
    hidden = F.when(F.col("value") > 100, "").otherwise(F.concat("v", F.lit("M")))
    expected = F.when(F.col("k") < 20, "").otherwise(F.concat(F.col("k").cast("int").cast("string"), F.lit("M")))
    future = F.when(F.col("k") >= 90, "7.5M").otherwise("")
    return page(
        tr("2099-01-01", "", "", "", future, "1M", "2M", actual=4),
        tr(day, "x", "x", "x", "9M", "9M", actual=4),
        tr("soon", "", "", "", "8M", "1M", "2M", actual=4),
        tr(older, "", "", "", "-1.5M", "1M", "", "0.5M", actual=4),
        tr(day, "", "", "", hidden, "3.25M", expected, "4M", actual=4),
        tr(day, "", "", "", "6M", "", "1M", actual=4),
    )


@query(
    "c4_nearest_release",
    f"""SELECT event_id, CAST(ts AS DATE) AS date, CASE WHEN value > 100 THEN 6.0 ELSE value END AS actual,
        CASE WHEN value > 100 THEN NULL ELSE CAST(3.25 AS DOUBLE) END AS previous, CASE WHEN value > 100 THEN 1.0 WHEN k < 20 THEN 0.0 ELSE k END AS consensus,
        round(CASE WHEN value > 100 THEN 5.0 WHEN k < 20 THEN value ELSE value - k END, 6) AS surprise
        FROM (SELECT *, {K} AS k FROM events)""",
)
def _(spark, d):
    pages = events(spark, d).select("event_id", release_page().alias("html"))
    return rounded(extract.nearest_release(pages, F.to_date(now())), 6, "surprise")


@query(
    "c5_latest_release",
    f"""SELECT event_id, CASE WHEN k >= 90 THEN DATE '2099-01-01' ELSE CAST(ts AS DATE) END AS date,
        CAST(CASE WHEN k >= 90 THEN 7.5 ELSE 9.0 END AS DOUBLE) AS actual, CAST(CASE WHEN k >= 90 THEN 2.0 ELSE 0.0 END AS DOUBLE) AS consensus,
        CAST(CASE WHEN k >= 90 THEN 5.5 ELSE 9.0 END AS DOUBLE) AS surprise FROM (SELECT *, {K} AS k FROM events)""",
)
def _(spark, d):
    pages = events(spark, d).select("event_id", release_page().alias("html"))
    return extract.latest_release(pages).drop("previous")


def ticker_page():
    shown = F.when(F.col("k") < 50, F.concat(F.lit("$"), "v")).otherwise(F.lit("loading"))
    label = F.when(F.col("k") < 80, F.concat(F.lit("<div data-bind=\"text: tickingAvgLastUpdated\">at "), "event_type", F.lit("</div>")))
    return F.concat(
        F.lit("<html><head><title>$2.22</title><script>var p = '$3.33';</script></head><body><p>was $12.50</p><p id=\"tickingAvgPriceText\">"),
        shown,
        F.lit("</p>"),
        F.coalesce(label, F.lit("")),
        F.lit("<p>now $"),
        F.col("v"),
        F.lit("</p></body></html>"),
    )


@query(
    "c6_ticker",
    f"""SELECT event_id, CASE WHEN k < 50 OR (value > 1 AND value < 10) THEN value END AS price,
        CASE WHEN k < 80 THEN 'at ' || event_type ELSE 'Unknown' END AS label FROM (SELECT *, {K} AS k FROM events)""",
)
def _(spark, d):
    return extract.ticker(events(spark, d).select("event_id", ticker_page().alias("html")))


@query(
    "c7_assembled",
    f"""SELECT '{RETAIL}' AS source, 'regular_gas' AS fuel_type, value AS price, CASE WHEN k < 80 THEN 'at ' || event_type ELSE 'Unknown' END AS label_ts,
        'United States' AS region, ts AS scraped_at, 1 AS kept FROM (SELECT *, {K} AS k FROM events) WHERE k < 50 OR (value > 1 AND value < 10)
        UNION ALL SELECT NULL, NULL, NULL, CASE WHEN k < 80 THEN 'at ' || event_type ELSE 'Unknown' END, NULL, ts, 0
        FROM (SELECT *, {K} AS k FROM events) WHERE NOT (k < 50 OR (value > 1 AND value < 10))""",
)
def _(spark, d):
    pages = events(spark, d).select("event_id", F.col("ts").alias("read_at"), ticker_page().alias("html"))
    good, bad = extract.retail_observations(pages, F.col("read_at"))
    bad = bad.select(F.col("label").alias("label_ts"), F.col("read_at").alias("scraped_at"), F.lit(0).alias("kept"))
    return good.withColumn("kept", F.lit(1)).unionByName(bad, allowMissingColumns=True)


COLLECT_FROM = "2024-01-15 12:30:00"


def source_page():
    """A page of the kind its source has; from k = 90 on it holds no price."""
    told = F.col("k") < 90
    quote = F.concat(
        F.lit("<html><body>"),
        F.when(told, F.concat(F.lit('<bg-quote class="value">$'), "v", F.lit("</bg-quote>"))).otherwise(""),
        F.when(F.col("k") >= 20, F.concat(F.lit('<span class="timestamp__time">Last Updated: '), "event_type", F.lit("</span>"))).otherwise(""),
        F.lit("</body></html>"),
    )
    wti = F.concat(
        F.lit('<html><body><p class="price">'), F.when(told, F.col("v")).otherwise("closed"), F.lit('</p><p class="last-updated">now</p></body></html>')
    )
    label = F.when(told, "Current Avg.").otherwise("Month Ago Avg.")
    average = page(tr("Yesterday Avg.", "$1.234"), tr(label, F.concat(F.lit("$"), "v")))
    shown = F.when(told, F.concat(F.lit("$"), "v")).otherwise("loading")
    retail = F.concat(F.lit('<html><body><p id="tickingAvgPriceText">'), shown, F.lit("</p></body></html>"))
    day = F.date_format("ts", "yyyy-MM-dd")
    expected = F.when(F.col("k") < 20, "").otherwise(F.concat(F.col("k").cast("int").cast("string"), F.lit("M")))
    actual = F.when(told, F.concat("v", F.lit("M"))).otherwise("")
    release = page(tr("2099-01-01", "", "", "", "9M", "1M", "2M"), tr(day, "", "", "", actual, "1M", expected))
    kinds = {RETAIL: retail, DAILY_AVG: average, RBOB: quote, WTI: wti, STOCKS: release, RUNS: release}
    return F.coalesce(*[F.when(F.col("source") == s, html) for s, html in kinds.items()])


@query(
    "a4_collect",
    f"""WITH {OBS}, e AS (SELECT *, date_trunc('hour', scraped_at) AS hour_of, {ny("date_trunc('hour', scraped_at)")} AS w2,
            scraped_at <= TIMESTAMP '{COLLECT_FROM}' AS old FROM obs),
        l AS (SELECT source, arg_max(price, (hour_of, seq)) AS l FROM e WHERE old GROUP BY source),
        w AS (SELECT source, arg_max(price, (hour_of, seq)) AS w FROM e WHERE old AND hour_of <= TIMESTAMP '{COLLECT_FROM}' - INTERVAL 7 DAY GROUP BY source),
        j AS (SELECT e.*, {jump_sql('price', 'l')} AS lj, {jump_sql('price', 'w')} AS wj FROM e LEFT JOIN l USING (source) LEFT JOIN w USING (source) WHERE NOT old),
        s AS (SELECT *, CASE WHEN consensus >= 90 THEN 'unread' WHEN source IN ({NAMES}) AND lj > 0.5 THEN 'last'
            WHEN source IN ({NAMES}) AND wj > 0.5 THEN 'week' END AS r FROM j),
        u AS (SELECT *, row_number() OVER (PARTITION BY source, hour_of, r IS NULL ORDER BY seq) AS i FROM s),
        v AS (SELECT *, coalesce(r, CASE WHEN EXISTS (SELECT 1 FROM e x WHERE x.old AND x.source = u.source AND x.hour_of = u.hour_of) THEN 'stored' WHEN i > 1 THEN 'copy' END) AS reason FROM u)
        SELECT seq AS page_id, source, fuel_type, CASE WHEN consensus < 90 THEN price END AS price,
            CASE WHEN source = '{RETAIL}' THEN 'Unknown' WHEN source = '{DAILY_AVG}' THEN 'Current as of ' || strftime(w2, '%Y-%m-%d')
                WHEN consensus >= 90 AND source <> '{WTI}' THEN NULL
                WHEN source = '{RBOB}' THEN CASE WHEN consensus >= 20 THEN 'purchase' ELSE 'Unknown' END
                WHEN source = '{WTI}' THEN 'now' ELSE strftime(scraped_at, '%Y-%m-%d') END AS label_ts,
            'United States' AS region,
            CASE WHEN source = '{STOCKS}' AND consensus < 90 THEN CASE WHEN consensus < 20 THEN 0.0 ELSE consensus END END AS consensus,
            round(CASE WHEN source = '{STOCKS}' AND consensus < 90 THEN price - CASE WHEN consensus < 20 THEN 0.0 ELSE consensus END END, 6) AS surprise,
            hour_of AS scraped_at, CASE WHEN source = '{DAILY_AVG}' THEN CAST(w2 AS DATE) - 1 END AS as_of_date,
            CASE WHEN reason IS NULL THEN 1 ELSE 0 END AS accepted, reason FROM v""",
)
def _(spark, d):
    """Pages of six kinds read by the hour, collected on top of the rows stored before
    them; what was written is read back with its rejects."""
    at = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    cut = ntz(COLLECT_FROM)
    stored = observations(spark, d).filter(F.col("scraped_at") <= cut)
    stored = stored.withColumn("scraped_at", F.date_trunc("hour", "scraped_at").cast("timestamp_ntz"))
    seen = events(spark, d).filter(F.col("ts") > cut).withColumn("source", source_of_event())
    pages = seen.select(F.col("event_id").alias("page_id"), "source", at.alias("read_at"), source_page().alias("html"))
    tagged = collect(pages, stored, cut, F.col("read_at"), F.to_date("read_at"), tie="seq")
    folder = new_folder(spark, "collected")
    sinks.append_collected(tagged, folder)
    back = as_double(sinks.read_collected(spark, folder, sinks.stored_types(tagged).schema))
    return rounded(back.withColumn("accepted", F.col("accepted").cast("int")), 6, "surprise")
