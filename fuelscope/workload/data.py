"""Scans, exports, imports, set operations, scalar functions (A, B, F12, G, H, I18)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..functions import arith, clock, text
from ..operators import lookup
from ..plans.imports import clean_import
from ..schema import DAILY_AVG, RETAIL, STOCKS, as_double
from ..session import new_folder
from ..sources import observations as obs_source
from ..sources import sinks
from ..sources.pages import source_of
from .frames import NOW, OBS, now, observations, table, utc
from .registry import bigint, query, rounded


@query(
    "a1_recent_scan",
    f"""WITH {OBS} SELECT seq, source, price, label_ts, region, consensus, scraped_at FROM obs
        WHERE scraped_at >= CAST(CAST(TIMESTAMP '{NOW}' AS DATE) - INTERVAL 14 DAY AS TIMESTAMP)""",
)
def _(spark, d):
    df = obs_source.recent(observations(spark, d), now(), 14)
    return df.select("seq", "source", "price", "label_ts", "region", "consensus", "scraped_at")


@query(
    "a3_full_replace",
    f"""WITH {OBS} SELECT source, fuel_type, CAST(price AS DOUBLE) AS price, CASE WHEN consensus >= 50 THEN region END AS region, scraped_at FROM obs
        WHERE price < 100""",
)
def _(spark, d):
    """The second load leaves nothing of the first."""
    folder = new_folder(spark, "table")
    df = observations(spark, d)
    sinks.replace(df, folder)
    blank = F.when(F.col("consensus") >= 50, F.col("region")).otherwise("")
    sinks.replace(df.filter("price < 100").withColumn("region", blank), folder)
    stored = as_double(obs_source.read_stored(spark, folder))
    return stored.select("source", "fuel_type", "price", "region", "scraped_at")


@query(
    "a4_append",
    f"""WITH {OBS} SELECT source, fuel_type, region, label_ts, price, TIMESTAMP '{NOW}' AS scraped_at FROM obs WHERE price < 100
        UNION ALL SELECT source, fuel_type, region, label_ts, price, TIMESTAMP '{NOW}' + INTERVAL 1 DAY FROM obs WHERE price >= 100""",
)
def _(spark, d):
    folder = new_folder(spark, "table")
    df = observations(spark, d)
    sinks.append(df.filter("price < 100"), folder, now())
    sinks.append(df.filter("price >= 100"), folder, now() + F.expr("interval 1 day"))
    sinks.append(df.filter("price < 0"), folder, now())
    stored = as_double(obs_source.read_stored(spark, folder))
    return stored.select("source", "fuel_type", "region", "label_ts", "price", "scraped_at")


@query(
    "a5_insert_if_absent",
    f"""WITH {OBS}, k AS (SELECT seq, CASE WHEN consensus < 90 THEN source END AS source, fuel_type,
            date_trunc('hour', scraped_at) AS scraped_at, price FROM obs),
        fresh AS (SELECT * FROM k WHERE source IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY source, fuel_type, scraped_at ORDER BY seq) = 1)
        SELECT * FROM fresh f WHERE NOT EXISTS (SELECT 1 FROM k s WHERE s.price >= 100 AND s.source = f.source
            AND s.fuel_type = f.fuel_type AND s.scraped_at = f.scraped_at)
        UNION ALL SELECT * FROM k WHERE source IS NULL""",
)
def _(spark, d):
    keyed = observations(spark, d).select(
        "seq",
        F.when(F.col("consensus") < 90, F.col("source")).alias("source"),
        "fuel_type",
        F.date_trunc("hour", "scraped_at").cast("timestamp_ntz").alias("scraped_at"),
        "price",
    )
    return lookup.insert_if_absent(keyed.filter("price >= 100"), keyed)


@query(
    "a6_full_export",
    f"WITH {OBS} SELECT source, fuel_type, price, label_ts, region, scraped_at, consensus, round(surprise, 8) AS surprise FROM obs ORDER BY scraped_at DESC",
)
def _(spark, d):
    rows = obs_source.project_existing(observations(spark, d)).orderBy(F.desc("scraped_at"))
    return rounded(rows, 8, "surprise")


@query(
    "a7_backup_slices",
    f"""WITH {OBS}, t AS (SELECT DATE '2024-01-30' AS today), d AS (SELECT seq, CAST(scraped_at AS DATE) AS day FROM obs)
        SELECT seq, 'today' AS slice FROM d, t WHERE day = today
        UNION ALL SELECT seq, 'yesterday' FROM d, t WHERE day = today - 1
        UNION ALL SELECT seq, 'month' FROM d, t WHERE day >= date_trunc('month', today)""",
)
def _(spark, d):
    return sinks.backup_slices(observations(spark, d), F.to_date(now())).select("seq", "slice")


REPORT = f"""source, fuel_type, price, label_ts, region, scraped_at,
    CASE WHEN source = '{STOCKS}' THEN consensus END AS consensus,
    CASE WHEN source = '{STOCKS}' THEN round(surprise, 8) END AS surprise"""


@query("a8_daily_report", f"WITH {OBS} SELECT {REPORT} FROM obs WHERE CAST(scraped_at AS DATE) = DATE '2024-01-30'")
def _(spark, d):
    return rounded(sinks.daily_report(observations(spark, d), F.to_date(now())), 8, "surprise")


@query("a9_monthly_report", f"WITH {OBS} SELECT {REPORT} FROM obs WHERE CAST(scraped_at AS DATE) >= DATE '2024-01-01'")
def _(spark, d):
    return rounded(sinks.monthly_report(observations(spark, d), F.to_date(now())), 8, "surprise")


@query(
    "a10_added_columns",
    f"""WITH {OBS} SELECT seq, source, CASE WHEN price >= 100 THEN consensus END AS consensus, CAST(NULL AS DOUBLE) AS surprise,
        CAST(NULL AS DATE) AS as_of_date FROM obs""",
)
def _(spark, d):
    """Rows of before and after a column was added."""
    df = observations(spark, d)
    old = df.filter("price < 100").select("seq", "source")
    new = df.filter("price >= 100").select("seq", "source", "consensus")
    return sinks.evolve(old.unionByName(new, allowMissingColumns=True))


_A11 = [("seq", "bigint", "seq"), ("source", "string", "source"), ("price", "double", "CASE WHEN price >= 100 THEN price END"), ("scraped_at", "timestamp_ntz", "scraped_at"), ("as_of_date", "date", "CAST(NULL AS DATE)")]


@query(
    "a11_columns",
    f"WITH {OBS} "
    + " UNION ALL ".join(
        f"SELECT {i + 1} AS ordinal, '{name}' AS column_name, '{kind}' AS data_type, count(*) AS n_rows, count({value}) AS n_values FROM obs"
        for i, (name, kind, value) in enumerate(_A11)
    ),
)
def _(spark, d):
    """Columns of a table some of whose values are missing."""
    df = observations(spark, d).withColumn("price", F.when(F.col("price") >= 100, F.col("price"))).withColumn("as_of_date", F.lit(None).cast("date"))
    return obs_source.describe_schema(df.select(*[name for name, _, _ in _A11])).drop("is_nullable")


@query(
    "a12_contract",
    f"""WITH {OBS} SELECT 'source' AS column_name, 'null' AS problem, count(*) AS n FROM obs WHERE consensus < 10 HAVING count(*) > 0
        UNION ALL SELECT 'as_of_date', 'missing', 1 UNION ALL SELECT 'price', 'type double', 1
        UNION ALL SELECT 'consensus', 'type double', 1 UNION ALL SELECT 'surprise', 'type double', 1""",
)
def _(spark, d):
    df = observations(spark, d)
    return obs_source.contract_violations(df.withColumn("source", F.when(F.col("consensus") >= 10, F.col("source"))))


PAGE_RULES = [(".example.com", "com_site"), (".example.net", "net_site"), ("example", "other_site")]


@query(
    "a13_page_source",
    """SELECT page_id, url, CASE WHEN contains(url, '.example.com') THEN 'com_site'
        WHEN contains(url, '.example.net') THEN 'net_site' WHEN contains(url, 'example') THEN 'other_site' END AS source
        FROM pages WHERE contains(url, 'example')""",
)
def _(spark, d):
    pages = table(spark, d, "pages").select("page_id", "url")
    return pages.withColumn("source", source_of(F.col("url"), PAGE_RULES)).filter("source is not null")


@query(
    "b1_parse_price",
    """WITH p AS (SELECT doc_id, regexp_replace(split_part(text, ' ', 1), '[^0-9.]', '', 'g') AS w,
            regexp_replace(text, '[^0-9.]', '', 'g') AS digits FROM documents)
        SELECT doc_id, CAST(CASE WHEN regexp_full_match(w, '[0-9]+\\.?[0-9]*|\\.[0-9]+') THEN w END AS DOUBLE) AS first_word,
            CAST(CASE WHEN regexp_full_match(digits, '[0-9]+\\.?[0-9]*|\\.[0-9]+') THEN digits END AS DOUBLE) AS whole FROM p""",
)
def _(spark, d):
    docs = table(spark, d, "documents")
    word = F.split_part("text", F.lit(" "), F.lit(1))
    return docs.select(
        "doc_id", text.parse_price(word).alias("first_word"), text.parse_price(F.col("text")).alias("whole")
    )


@query("b2_dollar_price", "SELECT event_id, value AS price FROM events")
def _(spark, d):
    shown = F.concat(F.lit(" $ "), F.format_string("%.2f", "value"), F.lit(" "))
    return table(spark, d, "events").select("event_id", text.dollar_price(shown).alias("price"))


@query(
    "b3_magnitude",
    """SELECT event_id, -value AS actual, CASE WHEN value < 20 THEN 0.0 ELSE value END AS consensus,
        CASE WHEN value < 20 THEN NULL ELSE value END AS consensus_or_null FROM events""",
)
def _(spark, d):
    cell = F.concat(F.format_string("%.2f", "value"), F.lit("M"))
    expected = F.when(F.col("value") < 20, F.lit(" ")).otherwise(cell)
    return table(spark, d, "events").select(
        "event_id",
        text.magnitude(F.concat(F.lit("-"), cell)).alias("actual"),
        text.consensus_value(expected).alias("consensus"),
        text.consensus_value(expected, "null").alias("consensus_or_null"),
    )


@query(
    "b4_first_plausible_price",
    """SELECT event_id, CASE WHEN value > 1 AND value < 10 THEN value WHEN k / 10.0 > 1 AND k / 10.0 < 10 THEN k / 10.0 END AS price
        FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS k FROM events)""",
)
def _(spark, d):
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("double") / 10.0
    body = F.format_string("From $12.50, now $%.2f (was $%.1f) or $0.5 off", F.col("value"), k)
    return table(spark, d, "events").select("event_id", text.first_plausible_price(body).alias("price"))


@query(
    "b5_clean_label",
    """SELECT event_id, CASE WHEN event_type = 'view' THEN 'Unknown' ELSE event_type END AS label FROM events""",
)
def _(spark, d):
    shown = F.when(F.col("event_type") == "view", F.lit("Last Updated:  ")).otherwise(
        F.concat(F.lit(" Last Updated: "), "event_type")
    )
    return table(spark, d, "events").select("event_id", text.clean_label(shown).alias("label"))


@query(
    "b6_event_time",
    f"""WITH {OBS} SELECT seq, source, CASE WHEN source = '{DAILY_AVG}' THEN {utc("CAST(day AS TIMESTAMP) + INTERVAL 8 HOUR")}
        WHEN source LIKE 'tradingeconomics%' THEN {utc("date_trunc('day', scraped_at)")}
        ELSE date_trunc('second', scraped_at) END AS event_time FROM obs""",
)
def _(spark, d):
    df = observations(spark, d)
    when = clock.event_time(F.col("source"), F.col("label_ts"), F.col("label_ts"))
    return df.select("seq", "source", F.coalesce(when, now()).alias("event_time"))


@query("b7_as_of_from_label", f"WITH {OBS} SELECT seq, CASE WHEN source = '{DAILY_AVG}' THEN day END AS as_of_date FROM obs")
def _(spark, d):
    df = observations(spark, d)
    return df.select("seq", clock.as_of_from_label(F.col("source"), F.col("label_ts")).alias("as_of_date"))


@query(
    "b8_as_of_by_lag",
    f"WITH {OBS} SELECT seq, day - 1 AS as_of_date, 'Current as of ' || strftime(day, '%Y-%m-%d') AS label FROM obs",
)
def _(spark, d):
    at = F.col("scraped_at")
    return observations(spark, d).select(
        "seq", clock.as_of_by_lag(at).alias("as_of_date"), clock.as_of_label(at).alias("label")
    )


@query(
    "b9_normal_fuel_type",
    f"WITH {OBS} SELECT seq, CASE WHEN source = '{RETAIL}' THEN 'regular_gas' ELSE fuel_type END AS fuel_type FROM obs",
)
def _(spark, d):
    df = observations(spark, d)
    shown = F.when(F.col("source") == RETAIL, F.lit(" Regular")).otherwise(F.concat(F.upper("fuel_type"), F.lit(" ")))
    return df.select("seq", text.normal_fuel_type(F.col("source"), shown).alias("fuel_type"))


@query(
    "b11_named_rows",
    f"WITH {OBS} SELECT seq, source, fuel_type FROM obs WHERE consensus >= 30",
)
def _(spark, d):
    df = observations(spark, d)
    k = F.col("consensus")
    name = F.when(k < 10, F.lit(" NaN ")).when(k < 20, F.lit("  ")).when(k >= 30, F.col("source"))
    df = df.withColumn("source", name)
    return df.filter(~text.is_blank_name(F.col("source")) & ~text.is_blank_name(F.col("fuel_type"))).select(
        "seq", "source", "fuel_type"
    )


@query("b10_number", f"WITH {OBS} SELECT seq, CASE WHEN consensus >= 20 THEN price END AS price FROM obs")
def _(spark, d):
    df = observations(spark, d)
    shown = F.when(F.col("consensus") < 10, F.lit("oops")).when(F.col("consensus") >= 20, F.format_string(" %.2f", "price"))
    return df.select("seq", text.number(shown).alias("price"))


@query("b12_new_york_time", f"WITH {OBS} SELECT seq, wall, hour(wall) AS h FROM obs")
def _(spark, d):
    wall = clock.to_new_york(F.col("scraped_at"))
    return observations(spark, d).select("seq", wall.alias("wall"), bigint(F.hour(wall)).alias("h"))


@query(
    "b13_calendar",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
        last_day(o_orderdate) AS month_end, CAST(CAST(o_orderdate AS DATE) + (7 - (isodow(o_orderdate) % 7)) * INTERVAL 1 DAY AS DATE) AS next_sunday,
        isodow(o_orderdate) - 1 AS weekday FROM orders""",
)
def _(spark, d):
    day = F.to_date("o_orderdate")
    return table(spark, d, "orders").select(
        "o_orderkey",
        day.alias("d"),
        clock.month_start(day).alias("month_start"),
        clock.month_end(day).alias("month_end"),
        clock.next_sunday(day).alias("next_sunday"),
        bigint(F.weekday(day)).alias("weekday"),
    )


@query(
    "b14_week_anchor",
    f"""WITH {OBS}, m AS (SELECT seq, wall, date_trunc('week', wall) + INTERVAL 12 HOUR AS noon FROM obs)
        SELECT seq, CASE WHEN wall < noon THEN noon - INTERVAL 7 DAY ELSE noon END AS anchor FROM m""",
)
def _(spark, d):
    return observations(spark, d).select("seq", clock.week_anchor(F.col("scraped_at")).alias("anchor"))


@query("b15_round_to_05", "SELECT event_id, round_even(value * 20, 0) / 20 AS rounded FROM events")
def _(spark, d):
    return table(spark, d, "events").select("event_id", arith.round_to_05(F.col("value")).alias("rounded"))


@query(
    "b16_surprise",
    "SELECT l_orderkey, l_linenumber, l_extendedprice - l_quantity AS surprise FROM lineitem",
)
def _(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", arith.surprise(F.col("l_extendedprice"), F.col("l_quantity")).alias("surprise")
    )


@query(
    "b17_jump",
    """SELECT event_id, CASE WHEN k = 0 OR k IS NULL THEN 0.0 ELSE abs((value - k) / k) END AS jump
        FROM (SELECT *, CASE WHEN event_type <> 'error' THEN CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) END AS k FROM events)""",
)
def _(spark, d):
    k = F.when(F.col("event_type") != "error", F.regexp_extract("props", "([0-9]+)", 1).cast("double"))
    return table(spark, d, "events").select("event_id", arith.jump(F.col("value"), k).alias("jump"))


@query("b18_soft_clip", "SELECT event_id, round(tanh((value - 50) / 100 / 0.03) * 0.03, 9) AS clipped FROM events")
def _(spark, d):
    x = (F.col("value") - 50) / 100
    return table(spark, d, "events").select("event_id", F.round(arith.soft_clip(x), 9).alias("clipped"))


@query(
    "b19_recency_weight",
    """SELECT o_orderkey, round(exp(-ln(2.0) / 90 * date_diff('day', CAST(o_orderdate AS DATE), m)), 9) AS w
        FROM orders, (SELECT CAST(max(o_orderdate) AS DATE) AS m FROM orders)""",
)
def _(spark, d):
    orders = table(spark, d, "orders")
    # One row.
    newest = orders.agg(F.to_date(F.max("o_orderdate")).alias("newest"))
    age = F.datediff("newest", F.to_date("o_orderdate")).cast("double")
    return orders.crossJoin(F.broadcast(newest)).select("o_orderkey", F.round(arith.recency_weight(age), 9).alias("w"))


@query("b20_crack_spread", f"WITH {OBS} SELECT seq, round(42 * price, 6) AS per_barrel, round(42 * price - consensus, 6) AS spread FROM obs")
def _(spark, d):
    df = observations(spark, d)
    out = df.select(
        "seq",
        arith.per_barrel(F.col("price")).alias("per_barrel"),
        arith.crack_spread(F.col("price"), F.col("consensus")).alias("spread"),
    )
    return rounded(out)


@query("b22_predicates", f"WITH {OBS} SELECT seq, source, label_ts FROM obs WHERE label_ts LIKE '%Current%' AND source = '{DAILY_AVG}' AND day >= DATE '2024-01-10' AND day <= DATE '2024-01-20' AND price IS NOT NULL")
def _(spark, d):
    df = observations(spark, d)
    day = clock.ny_date(F.col("scraped_at"))
    return df.filter(
        F.col("label_ts").like("%Current%")
        & (F.col("source") == DAILY_AVG)
        & day.between("2024-01-10", "2024-01-20")
        & F.col("price").isNotNull()
    ).select("seq", "source", "label_ts")


@query(
    "b23_display_text",
    f"""WITH {OBS} SELECT seq, CASE WHEN source = '{STOCKS}' THEN 'No data' ELSE '$' || printf('%.3f', price) END AS money,
        printf('%.1f', consensus) || '%' AS share, strftime(wall, '%Y-%m-%d %H:%M') || ' EST' AS at FROM obs""",
)
def _(spark, d):
    df = observations(spark, d)
    price = F.when(F.col("source") != STOCKS, F.col("price"))
    return df.select(
        "seq",
        text.money(price).alias("money"),
        text.percent(F.col("consensus") / 100.0).alias("share"),
        clock.zone_text(F.col("scraped_at")).alias("at"),
    )


@query(
    "b24_market_open",
    f"""WITH {OBS} SELECT seq, CAST((isodow(wall) = 7 AND hour(wall) >= 18) OR isodow(wall) < 5 OR (isodow(wall) = 5 AND hour(wall) < 20) AS INTEGER) AS open FROM obs""",
)
def _(spark, d):
    return observations(spark, d).select("seq", clock.market_open(F.col("scraped_at")).cast("int").alias("open"))


@query(
    "f12_keep_first",
    f"""WITH {OBS}, u AS (SELECT source, fuel_type, date_trunc('hour', scraped_at) AS scraped_at, price, seq FROM obs
            UNION ALL SELECT source, fuel_type, date_trunc('hour', scraped_at), -price, seq + 1000000000 FROM obs)
        SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY source, fuel_type, scraped_at ORDER BY seq) = 1""",
)
def _(spark, d):
    hour = F.date_trunc("hour", "scraped_at").cast("timestamp_ntz").alias("scraped_at")
    df = observations(spark, d).select("source", "fuel_type", hour, "price", "seq")
    copies = df.withColumns({"price": -F.col("price"), "seq": F.col("seq") + 1000000000})
    return lookup.keep_first(df.unionByName(copies), ["source", "fuel_type", "scraped_at"], "seq")


@query("g1_newest_20", f"WITH {OBS} SELECT seq, price, label_ts, region, source, fuel_type, scraped_at FROM obs ORDER BY scraped_at DESC, seq DESC LIMIT 20")
def _(spark, d):
    df = observations(spark, d).select("seq", "price", "label_ts", "region", "source", "fuel_type", "scraped_at")
    return lookup.newest(df)


@query("g2_full_sort", f"WITH {OBS} SELECT seq, source, price, scraped_at FROM obs ORDER BY scraped_at, seq")
def _(spark, d):
    return observations(spark, d).select("seq", "source", "price", "scraped_at").orderBy("scraped_at", "seq")


@query(
    "h1_union_of_shapes",
    f"""WITH {OBS} SELECT seq, source, price, CASE WHEN source = '{STOCKS}' THEN consensus END AS consensus,
        CASE WHEN source = '{STOCKS}' THEN round(surprise, 8) END AS surprise,
        CASE WHEN source = '{DAILY_AVG}' THEN day - 1 END AS as_of_date FROM obs""",
)
def _(spark, d):
    df = observations(spark, d)
    lag = clock.as_of_by_lag(F.col("scraped_at")).alias("as_of_date")
    average = df.filter(F.col("source") == DAILY_AVG).select("seq", "source", "price", lag)
    stocks = df.filter(F.col("source") == STOCKS).select("seq", "source", "price", "consensus", "surprise")
    rest = df.filter(~F.col("source").isin(DAILY_AVG, STOCKS)).select("seq", "source", "price")
    joined = rest.unionByName(stocks, allowMissingColumns=True).unionByName(average, allowMissingColumns=True)
    return rounded(joined, 8, "surprise")


@query(
    "i18_clean_import",
    f"""WITH {OBS}, t AS (SELECT *, CASE WHEN source = '{DAILY_AVG}' THEN {utc("CAST(day AS TIMESTAMP) + INTERVAL 8 HOUR")}
            WHEN source LIKE 'tradingeconomics%' THEN {utc("date_trunc('day', scraped_at)")} ELSE date_trunc('second', scraped_at) END AS at_time FROM obs)
        SELECT source, fuel_type, price, label_ts, region, at_time AS scraped_at, CASE WHEN source = '{DAILY_AVG}' THEN day END AS as_of_date
        FROM t WHERE consensus >= 5 QUALIFY row_number() OVER (PARTITION BY source, fuel_type, at_time ORDER BY seq) = 1""",
)
def _(spark, d):
    """Events written as text files in order, read back and cleaned."""
    folder = new_folder(spark, "drop")
    df = observations(spark, d).withColumn("source", F.when(F.col("consensus") >= 5, F.col("source")).otherwise(" nan "))
    text_rows = df.orderBy("seq").select(
        "source",
        F.concat(F.lit(" "), F.upper("fuel_type")).alias("fuel_type"),
        F.format_string("%.2f", "price").alias("price"),
        F.col("label_ts").alias("timestamp"),
        "region",
        F.col("label_ts").alias("scraped_at"),
    )
    text_rows.write.option("header", True).csv(folder)
    out, _ = clean_import(obs_source.read_csv(spark, folder), now())
    return out.select("source", "fuel_type", "price", "label_ts", "region", "scraped_at", "as_of_date")


@query(
    "i18_bad_input",
    f"""WITH {OBS}, t AS (SELECT *, seq % 11 = 0 AS bad, CASE WHEN source = '{DAILY_AVG}' THEN {utc("CAST(day AS TIMESTAMP) + INTERVAL 8 HOUR")}
            WHEN source LIKE 'tradingeconomics%' THEN {utc("date_trunc('day', scraped_at)")} ELSE date_trunc('second', scraped_at) END AS at_time FROM obs)
        SELECT source, fuel_type, CASE WHEN seq % 7 <> 0 THEN price END AS price, CASE WHEN bad THEN 'soon' ELSE label_ts END AS label_ts, region,
            CASE WHEN bad THEN TIMESTAMP '{NOW}' ELSE at_time END AS scraped_at, CASE WHEN source = '{DAILY_AVG}' AND NOT bad THEN day END AS as_of_date
        FROM t WHERE consensus >= 10 QUALIFY bad OR row_number() OVER (PARTITION BY bad, source, fuel_type, at_time ORDER BY seq) = 1""",
)
def _(spark, d):
    """A file with unreadable prices and times and with blank names of both columns."""
    folder = new_folder(spark, "drop")
    bad = F.col("seq") % 11 == 0
    label = F.when(bad, "soon").otherwise(F.col("label_ts"))
    price = F.when(F.col("seq") % 7 != 0, F.format_string("%.2f", "price")).otherwise(F.when(F.col("seq") % 2 == 0, "n/a").otherwise(F.lit("1.2.3")))
    text_rows = observations(spark, d).orderBy("seq").select(
        F.when(F.col("consensus") >= 5, F.col("source")).otherwise("NaN").alias("source"),
        F.when(F.col("consensus").between(5, 9), F.lit("  ")).otherwise(F.col("fuel_type")).alias("fuel_type"),
        price.alias("price"),
        label.alias("timestamp"),
        "region",
        label.alias("scraped_at"),
    )
    text_rows.write.option("header", True).csv(folder)
    out, _ = clean_import(obs_source.read_csv(spark, folder), now())
    return out.select("source", "fuel_type", "price", "label_ts", "region", "scraped_at", "as_of_date")


def _read_back(spark, folder, *more):
    """A written text table in the types of its columns."""
    text_rows = spark.read.option("header", True).csv(folder)
    kinds = {"price": "double", "consensus": "double", "surprise": "double", "scraped_at": "timestamp_ntz"}
    typed = text_rows.withColumns({c: F.col(c).cast(t) for c, t in kinds.items() if c in text_rows.columns})
    return rounded(typed.select("source", "fuel_type", "price", "label_ts", "region", "scraped_at", "consensus", "surprise", *more), 8, "surprise")


@query(
    "a6_export_read_back",
    f"WITH {OBS} SELECT source, fuel_type, price, label_ts, region, scraped_at, consensus, round(surprise, 8) AS surprise FROM obs",
)
def _(spark, d):
    folder = new_folder(spark, "export")
    sinks.export_csv(observations(spark, d), folder)
    return _read_back(spark, folder)


@query(
    "a7_backup_read_back",
    f"""WITH {OBS}, t AS (SELECT DATE '2024-01-30' AS today), d AS (SELECT source, fuel_type, price, label_ts, region, scraped_at, consensus,
            round(surprise, 8) AS surprise, CAST(scraped_at AS DATE) AS day FROM obs)
        SELECT * EXCLUDE (day, today), 'today' AS slice FROM d, t WHERE day = today
        UNION ALL SELECT * EXCLUDE (day, today), 'yesterday' FROM d, t WHERE day = today - 1
        UNION ALL SELECT * EXCLUDE (day, today), 'month' FROM d, t WHERE day >= date_trunc('month', today)""",
)
def _(spark, d):
    folder = new_folder(spark, "backup")
    sinks.write_backup(observations(spark, d), folder, date(2024, 1, 30))
    return _read_back(spark, folder, "slice")


@query("a8_report_read_back", f"WITH {OBS} SELECT {REPORT} FROM obs WHERE CAST(scraped_at AS DATE) = DATE '2024-01-30'")
def _(spark, d):
    folder = new_folder(spark, "report")
    sinks.write_report(sinks.daily_report(observations(spark, d), F.to_date(now())), folder)
    return _read_back(spark, folder)


@query("a9_report_read_back", f"WITH {OBS} SELECT {REPORT} FROM obs WHERE CAST(scraped_at AS DATE) >= DATE '2024-01-01'")
def _(spark, d):
    folder = new_folder(spark, "report")
    sinks.write_report(sinks.monthly_report(observations(spark, d), F.to_date(now())), folder)
    return _read_back(spark, folder)
