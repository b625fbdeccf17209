"""Panel, features, fit and forecast (E13, E14, I1-I11)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..plans import model
from ..plans.panel import DESIGN, daily_panel, features, training_rows
from ..session import cut_lineage
from . import panel_sql
from .frames import OBS, ORD, observations, order_observations
from .registry import NUDGE, bigint, query, rounded

KEYS = ["region"]
NO_MODEL = 10**9
PANEL = "region, date, " + ", ".join(
    f"round({c} + {NUDGE}, 6) AS {c}"
    for c in (
        "aaa", "gb", "rbob", "wti", "stocks_surprise", "refinery_runs", "gas_price", "GB_gap", "rbob_sm", "wti_sm",
    )
)


@query("i1_daily_panel_events", f"WITH {OBS}, {panel_sql.panel('obs')} SELECT {PANEL} FROM panel")
def _(spark, d):
    return rounded(daily_panel(observations(spark, d)), nudge=NUDGE)


@query("i1_daily_panel_orders", f"WITH {ORD}, {panel_sql.panel('ord')} SELECT {PANEL} FROM panel")
def _(spark, d):
    return rounded(daily_panel(order_observations(spark, d)), nudge=NUDGE)


FEATURES = "region, date, " + ", ".join(
    f"round({c} + {NUDGE}, 6) AS {c}" for c in ("Y", "rb_sm", "wti_sm", *[c for c in DESIGN if c != "one"])
)


@query("i2_features", f"WITH {ORD}, {panel_sql.features('ord')} SELECT {FEATURES} FROM feats")
def _(spark, d):
    feats = features(daily_panel(order_observations(spark, d)))
    return rounded(feats.select("region", "date", "Y", "rb_sm", "wti_sm", *[c for c in DESIGN if c != "one"]), nudge=NUDGE)


def weighted_fit(spark, d):
    fit = training_rows(features(daily_panel(order_observations(spark, d))))
    return model.with_weight(fit, KEYS)


@query("i2_training_rows", f"WITH {ORD}, {panel_sql.fit('ord')} SELECT {FEATURES}, round(w, 9) AS w FROM fit")
def _(spark, d):
    rows = weighted_fit(spark, d).select("region", "date", "Y", "rb_sm", "wti_sm", *[c for c in DESIGN if c != "one"], "w")
    return rounded(rounded(rows, 9, "w"), 6, *[c for c, t in rows.dtypes if t == "double" and c != "w"], nudge=NUDGE)


@query(
    "e13_tail_error",
    f"""WITH {ORD}, {panel_sql.fit('ord')}, i AS (SELECT region, abs(Y - AAA_l1) AS e, row_number() OVER (PARTITION BY region ORDER BY date) - 1 AS i,
        floor(count(*) OVER (PARTITION BY region) * 0.8) AS cut FROM fit) SELECT region, round(avg(e), 6) AS mae FROM i WHERE i >= cut GROUP BY region""",
)
def _(spark, d):
    return rounded(model.tail_error(weighted_fit(spark, d), KEYS, mae=F.col("Y") - F.col("AAA_l1")))


@query("e14_gram", f"WITH {ORD}, {panel_sql.gram('ord')}")
def _(spark, d):
    return rounded(model.gram(weighted_fit(spark, d), KEYS))


def result(spark, d, **options):
    return model.nowcast(order_observations(spark, d), KEYS, **options)


CHOSEN = f"WITH RECURSIVE {ORD}, {panel_sql.chosen('ord')}"


@query("i3_ridge", f"{CHOSEN} SELECT region, CAST(unnest(range(0, 10)) AS BIGINT) AS i, round(unnest(b_aug), 3) AS beta FROM chosen")
def _(spark, d):
    """Coefficients to three digits: the design is singular but for the penalty."""
    coefs = model.solve(model.gram(weighted_fit(spark, d), KEYS), KEYS)
    out = coefs.select("region", F.posexplode("b_aug").alias("i", "beta"))
    return rounded(out, 3).withColumn("i", bigint(F.col("i")))


@query(
    "i4_model_gate",
    f"{CHOSEN} SELECT region, round(mae_base, 6) AS mae_base, round(mae_aug, 6) AS mae_aug, CAST(use_pulses AS INTEGER) AS use_pulses, 1 AS enough_rows FROM chosen",
)
def _(spark, d):
    out = rounded(model.error_summary(result(spark, d), KEYS))
    return out.withColumns({c: F.col(c).cast("int") for c in ("use_pulses", "enough_rows")})


@query(
    "i5_forecast",
    f"{CHOSEN}, {panel_sql.STARTS}, {panel_sql.recursion([f'beta[{i + 1}]' for i in range(10)])} SELECT region, date, CAST(h AS BIGINT) AS h, round(yhat, 5) AS yhat FROM y",
)
def _(spark, d):
    return rounded(result(spark, d).forecast, 5).withColumn("h", bigint(F.col("h")))


# Fixed coefficients: the recursion is compared without a fit.
BETA = [0.1, 0.6, 0.5, 0.002, 0.05, 0.001, 0.01, 0.2, 0.03, 0.01]


@query(
    "i5_recursive_fold",
    f"""WITH RECURSIVE {ORD}, {panel_sql.features('ord')}, {panel_sql.STARTS}, chosen AS (SELECT region FROM starts),
        {panel_sql.recursion([str(b) for b in BETA])} SELECT region, date, CAST(h AS BIGINT) AS h, round(yhat, 6) AS yhat FROM y""",
)
def _(spark, d):
    done = result(spark, d, min_rows=NO_MODEL)
    fixed = done.starts.select("region", F.array(*[F.lit(b) for b in BETA]).alias("beta"))
    out = model.recursive_forecast(done.features, done.starts, fixed, KEYS)
    return rounded(out).withColumn("h", bigint(F.col("h")))


SHORT = f"WITH {ORD}, {panel_sql.features('ord')}, {panel_sql.FALLBACK}"


@query("i6_fallback_forecast", f"{SHORT} SELECT region, date, CAST(h AS BIGINT) AS h, round(yhat, 6) AS yhat FROM forecast")
def _(spark, d):
    return rounded(result(spark, d, min_rows=NO_MODEL).forecast).withColumn("h", bigint(F.col("h")))


@query(
    "i7_residuals",
    f"{CHOSEN} SELECT region, date, round(Y - ({panel_sql.predicted('beta', 10)}), 6) AS resid FROM fit JOIN chosen USING (region)",
)
def _(spark, d):
    return rounded(result(spark, d).residuals)


WITH_RESID = f"{SHORT}, {panel_sql.RESIDUALS}, {panel_sql.POINTS}"


@query("i7_fallback_residuals", f"{WITH_RESID} SELECT region, date, round(resid, 6) AS resid FROM resid")
def _(spark, d):
    return rounded(result(spark, d, min_rows=NO_MODEL).residuals)


# The real model: its forecast, its residuals, and the points read off them.
BETAS = [f"beta[{i + 1}]" for i in range(10)]
MODELLED = f"""{CHOSEN}, {panel_sql.STARTS}, {panel_sql.recursion(BETAS)}, forecast AS (SELECT region, date, h, yhat FROM y),
    resid AS (SELECT region, date, Y - ({panel_sql.predicted('beta', 10)}) AS resid FROM fit JOIN chosen USING (region)), {panel_sql.POINTS}"""


@query(
    "i8_exceedance_exact",
    f"""{MODELLED} SELECT p.region, round(eom_point, 5) AS eom_point, round(avg(CASE WHEN eom_point + resid > 2.5 THEN 1.0 ELSE 0.0 END), 8) AS probability
        FROM points p JOIN resid USING (region) GROUP BY p.region, eom_point""",
)
def _(spark, d):
    done = result(spark, d)
    targets = done.points.select("region", "eom_point", F.lit(2.5).alias("threshold"))
    out = model.exceedance_exact(done.residuals, targets, KEYS, "eom_point", "threshold").drop("threshold")
    return rounded(rounded(out, 8, "probability"), 5, "eom_point")


DRAWS = (5000, 10000)


@query(
    "i8_bootstrap",
    f"""{MODELLED}, pool AS (SELECT region, list(resid ORDER BY resid) AS pool FROM resid GROUP BY region),
        n AS (SELECT unnest({list(DRAWS)}) AS draws), draw AS (SELECT draws, unnest(range(1, draws + 1)) AS i FROM n),
        pick AS (SELECT draws, region, eom_point, pool, md5(concat('42|', region, '|', i)) AS m FROM draw, points JOIN pool USING (region)),
        sample AS (SELECT draws, region, eom_point + pool[CAST('0x' || substr(m, 1, 15) AS BIGINT) % len(pool) + 1] AS sample FROM pick)
        SELECT CAST(draws AS INTEGER) AS draws, region, round(avg(sample), 5) AS mean, round(quantile_cont(sample, 0.05), 5) AS p05, round(quantile_cont(sample, 0.95), 5) AS p95,
            round(avg(CASE WHEN sample > 2.5 THEN 1.0 ELSE 0.0 END), 8) AS probability FROM sample GROUP BY ALL""",
)
def _(spark, d):
    done = result(spark, d)
    # Small frames behind long plans: worked out once for all that reads them.
    resid, points = cut_lineage(done.residuals.select("region", "resid")), cut_lineage(done.points.select("region", "eom_point"))
    drawn = [model.bootstrap(resid, points, KEYS, "eom_point", n, 42).withColumn("draws", F.lit(n)) for n in DRAWS]
    samples = cut_lineage(reduce(DataFrame.unionByName, drawn))
    out = model.sample_summary(samples, ["draws", *KEYS], F.lit(2.5))
    return rounded(rounded(out, 8, "probability"), 5, "mean", "p05", "p95")


@query(
    "i9_threshold_table",
    f"""{MODELLED}, g AS (SELECT region, eom_point, round_even(eom_point * 20, 0) / 20 + unnest([-0.10, -0.05, 0.0, 0.05, 0.10, 0.15]) AS threshold FROM points)
        SELECT g.region, round(threshold, 6) AS threshold, round(avg(CASE WHEN eom_point + resid > threshold THEN 1.0 ELSE 0.0 END), 8) AS probability,
            '$' || printf('%.2f', threshold) AS threshold_text
        FROM g JOIN resid USING (region) GROUP BY g.region, threshold""",
)
def _(spark, d):
    done = result(spark, d)
    out = model.threshold_table(done.residuals, done.points, KEYS).drop("probability_text")
    return rounded(rounded(out, 8, "probability"), 6, "threshold")


@query(
    "i10_points",
    f"{MODELLED} SELECT region, next_sunday, round(next_sunday_point, 5) AS next_sunday_point, month_end, round(eom_point, 5) AS eom_point FROM points",
)
def _(spark, d):
    return rounded(result(spark, d).points, 5)


SUNDAY = f"""{MODELLED}, z AS (SELECT region, day - 1 AS sunday, avg(price) AS value FROM ord WHERE source = 'aaa_gas_prices' AND isodow(day - 1) = 7 GROUP BY ALL),
    z1 AS (SELECT region, round_even(arg_max(value, sunday), 3) AS reference FROM z GROUP BY region),
    prob AS (SELECT p.region, next_sunday, next_sunday_point, reference, avg(CASE WHEN next_sunday_point + resid > reference THEN 1.0 ELSE 0.0 END) AS probability
        FROM points p JOIN z1 USING (region) JOIN resid USING (region) GROUP BY ALL)"""


@query(
    "i11_sunday_probability",
    f"{SUNDAY} SELECT region, next_sunday, round(next_sunday_point, 5) AS next_sunday_point, reference, round(probability, 8) AS probability FROM prob",
)
def _(spark, d):
    df = order_observations(spark, d)
    out = model.sunday_probability(df, model.nowcast(df, KEYS), KEYS)
    return rounded(rounded(out, 8, "probability"), 5, "next_sunday_point")
