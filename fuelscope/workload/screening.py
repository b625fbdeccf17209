"""Plausibility screen and replay (I14, I15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import lookup
from ..operators.replay import replay, replay_last_only
from ..schema import SCREENED
from .frames import NOW, OBS, now, observations
from .registry import SQL, query, rounded

NAMES = ", ".join(f"'{s}'" for s in SCREENED)


def jump_sql(new: str, ref: str) -> str:
    return f"coalesce(abs(({new} - {ref}) / nullif({ref}, 0)), 0)"


@query(
    "i14_screen_batch",
    f"""WITH {OBS}, c AS (SELECT * FROM obs WHERE scraped_at > TIMESTAMP '{NOW}' - INTERVAL 1 DAY),
        h AS (SELECT * FROM obs WHERE scraped_at <= TIMESTAMP '{NOW}' - INTERVAL 1 DAY),
        r AS (SELECT region, source, arg_max(price, scraped_at) AS l,
            arg_max(price, scraped_at) FILTER (scraped_at <= TIMESTAMP '{NOW}' - INTERVAL 7 DAY) AS w FROM h GROUP BY ALL),
        j AS (SELECT c.*, l, w, {jump_sql('price', 'l')} AS lj, {jump_sql('price', 'w')} AS wj FROM c LEFT JOIN r USING (region, source))
        SELECT seq, round(lj, 6) AS last_jump, round(wj, 6) AS week_jump,
            CASE WHEN source NOT IN ({NAMES}) THEN NULL WHEN lj > 0.5 THEN 'last' WHEN wj > 0.5 THEN 'week' END AS reason FROM j""",
)
def _(spark, d):
    df = observations(spark, d)
    cut = now() - F.expr("interval 1 day")
    fresh, stored = df.filter(F.col("scraped_at") > cut), df.filter(F.col("scraped_at") <= cut)
    out = lookup.screen_batch(fresh, stored, now(), ["region", "source"], SCREENED)
    return rounded(out.select("seq", "last_jump", "week_jump", "reason"))


@query(
    "i14_null_region",
    SQL["i14_screen_batch"]
    .replace(", c AS (", ", o AS (SELECT * REPLACE (CASE WHEN seq % 3 <> 0 THEN region END AS region) FROM obs), c AS (", 1)
    .replace("* FROM obs WHERE", "* FROM o WHERE")
    .replace("LEFT JOIN r USING (region, source)", "LEFT JOIN r ON c.source = r.source AND c.region IS NOT DISTINCT FROM r.region")
    .replace("SELECT c.*, l, w", "SELECT c.*, r.l, r.w"),
)
def _(spark, d):
    df = observations(spark, d).withColumn("region", F.when(F.col("seq") % 3 != 0, F.col("region")))
    cut = now() - F.expr("interval 1 day")
    fresh, stored = df.filter(F.col("scraped_at") > cut), df.filter(F.col("scraped_at") <= cut)
    out = lookup.screen_batch(fresh, stored, now(), ["region", "source"], SCREENED)
    return rounded(out.select("seq", "last_jump", "week_jump", "reason"))


LAST_ONLY = f"""WITH RECURSIVE {OBS}, n AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY scraped_at, seq) AS i FROM obs),
    r AS (SELECT source, seq, i, price AS last, 1 AS accepted FROM n WHERE i = 1
        UNION ALL SELECT n.source, n.seq, n.i, CASE WHEN {jump_sql('n.price', 'r.last')} > 0.5 THEN r.last ELSE n.price END,
            CASE WHEN {jump_sql('n.price', 'r.last')} > 0.5 THEN 0 ELSE 1 END
        FROM r JOIN n ON n.source = r.source AND n.i = r.i + 1)
    SELECT seq, source, accepted FROM r"""


@query("i15_replay_last_only", LAST_ONLY)
def _(spark, d):
    df = observations(spark, d).select("seq", "source", "price", "scraped_at")
    out = replay_last_only(df, ["source"])
    return out.select("seq", "source", F.col("accepted").cast("int").alias("accepted"))


GAPS = """m AS (SELECT seq, CASE WHEN seq % 10 <> 0 THEN source END AS source, price, CASE WHEN seq % 10 <> 1 THEN scraped_at END AS scraped_at FROM obs)"""


@query(
    "i15_null_key_and_time",
    LAST_ONLY.replace(", n AS (SELECT *,", f", {GAPS}, n AS (SELECT *,").replace("FROM obs),\n    r AS", "FROM m WHERE scraped_at IS NOT NULL),\n    r AS").replace("n.source = r.source", "n.source IS NOT DISTINCT FROM r.source")
    + " UNION ALL SELECT seq, source, 0 FROM m WHERE scraped_at IS NULL",
)
def _(spark, d):
    """Missing keys are a series of their own; rows without a time stay, not accepted."""
    df = observations(spark, d).select(
        "seq", F.when(F.col("seq") % 10 != 0, F.col("source")).alias("source"), "price", F.when(F.col("seq") % 10 != 1, F.col("scraped_at")).alias("scraped_at")
    )
    out = replay_last_only(df, ["source"])
    return out.select("seq", "source", F.col("accepted").cast("int").alias("accepted"))


WEEK_FORM = f"""WITH RECURSIVE {OBS}, n AS (SELECT *, row_number() OVER (PARTITION BY region, source ORDER BY scraped_at, seq) AS i FROM obs),
    r AS (SELECT region, source, seq, i, [scraped_at] AS ts, [price] AS ps, 1 AS accepted FROM n WHERE i = 1
        UNION ALL SELECT region, source, seq, i, CASE WHEN bad THEN ts ELSE list_append(ts, t0) END,
            CASE WHEN bad THEN ps ELSE list_append(ps, price) END, CASE WHEN bad THEN 0 ELSE 1 END
        FROM (SELECT n.region, n.source, n.seq, n.i, n.price, n.scraped_at AS t0, r.ts, r.ps,
                ({jump_sql('n.price', 'r.ps[-1]')} > 0.5 OR {jump_sql('n.price', 'r.ps[len(list_filter(r.ts, lambda x: x <= n.scraped_at - INTERVAL 7 DAY))]')} > 0.5) AS bad
            FROM r JOIN n ON n.region = r.region AND n.source = r.source AND n.i = r.i + 1))
    SELECT seq, region, source, accepted FROM r"""


@query("i15_replay_by_region", WEEK_FORM)
def _(spark, d):
    df = observations(spark, d).select("seq", "region", "source", "price", "scraped_at")
    out = replay(df, ["region", "source"])
    return out.select("seq", "region", "source", F.col("accepted").cast("int").alias("accepted"))


@query("i15_replay_by_source", WEEK_FORM.replace("region, source, seq", "source, seq").replace("PARTITION BY region, source", "PARTITION BY source").replace("n.region, n.source", "n.source").replace("n.region = r.region AND ", "").replace("seq, region, source", "seq, source"))
def _(spark, d):
    df = observations(spark, d).select("seq", "source", "price", "scraped_at")
    return replay(df, ["source"]).select("seq", "source", F.col("accepted").cast("int").alias("accepted"))
