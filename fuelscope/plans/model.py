"""Weighted ridge nowcast, recursive forecast and what is read off it.

The sums of the normal equations are one Spark aggregate; only a small matrix per
region is solved, in tasks, many regions per batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from ..functions.arith import GALLONS_PER_BARREL, recency_weight, round_to_05
from ..functions.clock import next_sunday
from ..functions.text import money, percent
from ..operators.daily import exceedance, last_n, percentiles, previous_sunday
from ..operators.lookup import value_at_or_latest
from ..operators.series import SLOPE_DECAY, seed_slope, shift
from ..joins import join_same
from ..session import cut_lineage
from ..schema import DAILY_AVG
from .panel import BASE_SIZE, DESIGN, daily_panel, features, training_rows

RIDGE = 5e-4
GATE = 0.03
MIN_ROWS = 24
OFFSETS = [-0.10, -0.05, 0.0, 0.05, 0.10, 0.15]


def with_weight(fit: DataFrame, keys: list[str], half_life: int = 90) -> DataFrame:
    """Weight by age against the newest training row of the region."""
    newest = F.max("date").over(W.partitionBy(*keys))
    return fit.withColumn("w", recency_weight(F.datediff(newest, "date").cast("double"), half_life))


def gram(fit: DataFrame, keys: list[str], design: list[str] = DESIGN, y: str = "Y", w: str = "w") -> DataFrame:
    """Weighted sums of products: ``g_i_j`` for i <= j and ``b_i``, one row per key."""
    sums = [F.count(F.lit(1)).alias("n")]
    for i, a in enumerate(design):
        sums.append(F.sum(F.col(w) * F.col(a) * F.col(y)).alias(f"b_{i}"))
        for j in range(i, len(design)):
            sums.append(F.sum(F.col(w) * F.col(a) * F.col(design[j])).alias(f"g_{i}_{j}"))
    return fit.groupBy(*keys).agg(*sums)


def solve(sums: DataFrame, keys: list[str], k: int = len(DESIGN), base: int = BASE_SIZE, l2: float = RIDGE) -> DataFrame:
    """Ridge coefficients with a free intercept: ``b_base`` of the leading columns
    (padded with zeros) and ``b_aug`` of all."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            matrix = np.zeros((len(pdf), k, k))
            right = np.zeros((len(pdf), k, 1))
            for i in range(k):
                right[:, i, 0] = pdf[f"b_{i}"]
                for j in range(i, k):
                    matrix[:, i, j] = matrix[:, j, i] = pdf[f"g_{i}_{j}"]
            shrink = np.eye(k) * l2
            shrink[0, 0] = 0.0
            matrix = matrix + shrink
            whole = np.linalg.solve(matrix, right)[:, :, 0]
            part = np.zeros_like(whole)
            part[:, :base] = np.linalg.solve(matrix[:, :base, :base], right[:, :base])[:, :, 0]
            yield pdf[[*keys, "n"]].assign(b_base=list(part), b_aug=list(whole))

    fields = [f for f in sums.schema.fields if f.name in keys or f.name == "n"]
    numbers = T.ArrayType(T.DoubleType())
    shape = T.StructType([*fields, T.StructField("b_base", numbers), T.StructField("b_aug", numbers)])
    return sums.mapInPandas(run, shape)


def predict(beta: Column, design: list[str] = DESIGN) -> Column:
    total = F.lit(0.0)
    for i, c in enumerate(design):
        total = total + F.get(beta, F.lit(i)) * F.col(c)
    return total


def with_tail(fit: DataFrame, keys: list[str]) -> DataFrame:
    """``tail``: rows from int(n * 0.8) on, which judge the models."""
    place = F.row_number().over(W.partitionBy(*keys).orderBy("date")) - 1
    rows = F.count(F.lit(1)).over(W.partitionBy(*keys))
    return fit.withColumn("tail", place >= F.floor(rows * 0.8))


def tail_error(fit: DataFrame, keys: list[str], **errors: Column) -> DataFrame:
    """Mean absolute errors over the tail, one column per named error."""
    means = [F.avg(F.abs(e)).alias(name) for name, e in errors.items()]
    return with_tail(fit, keys).filter("tail").groupBy(*keys).agg(*means)


def gate(fit: DataFrame, coefs: DataFrame, keys: list[str], tolerance: float = GATE, holdout: DataFrame | None = None) -> DataFrame:
    """Errors of both models, ``use_pulses`` and the chosen ``beta``. With
    ``holdout`` the errors are those of coefficients fitted without the tail."""
    judged = join_same(fit, coefs if holdout is None else holdout, keys)
    errors = tail_error(
        judged,
        keys,
        mae_base=F.col("Y") - predict(F.col("b_base")),
        mae_aug=F.col("Y") - predict(F.col("b_aug")),
    )
    both = join_same(coefs, errors, keys, "left")
    wins = F.coalesce(F.col("mae_aug") <= F.col("mae_base") * (1.0 - tolerance), F.lit(False))
    return both.withColumn("use_pulses", wins).withColumn(
        "beta", F.when(F.col("use_pulses"), F.col("b_aug")).otherwise(F.col("b_base"))
    )


def residuals(fit: DataFrame, feats: DataFrame, chosen: DataFrame, keys: list[str]) -> DataFrame:
    """In-sample residuals where there is a model; else the last 60 daily moves of
    Y; else a single zero."""
    modelled = join_same(fit, chosen.select(*keys, "beta"), keys).select(
        *keys, "date", (F.col("Y") - predict(F.col("beta"))).alias("resid")
    )
    moves = join_same(feats, chosen.select(*keys), keys, "left_anti").withColumn(
        "resid", F.col("Y") - shift(F.col("Y"), keys, 1)
    )
    moves = last_n(moves, keys, 60, "resid").select(*keys, "date", "resid")
    real = modelled.unionByName(moves)
    rest = join_same(feats.select(*keys).distinct(), real.select(*keys).distinct(), keys, "left_anti")
    zero = rest.select(*keys, F.lit(None).cast("date").alias("date"), F.lit(0.0).alias("resid"))
    return real.unionByName(zero)


def horizon(feats: DataFrame, keys: list[str]) -> DataFrame:
    """Per region the forecast start, month end, length and the values it starts
    from: one row per region."""
    ends = feats.groupBy(*keys).agg(
        F.max("date").alias("last_date"),
        F.max(F.when(F.col("aaa").isNotNull(), F.col("date"))).alias("_last_aaa"),
        F.max_by(F.col("rb_sm") * GALLONS_PER_BARREL - F.col("wti_sm"), "date").alias("crack_now"),
        F.max_by("stocks_pulse", "date").alias("stocks_now"),
        F.max_by("refinery_pulse", "date").alias("refinery_now"),
    )
    ends = ends.withColumn("last_aaa_date", F.coalesce("_last_aaa", "last_date"))
    any_aaa = F.max("aaa").over(W.partitionBy(*keys)).isNotNull()
    seeds = feats.withColumn("_seed", F.when(any_aaa, F.col("aaa")).otherwise(F.col("Y")))
    seed = seed_slope(seeds.select(*keys, "date", "_seed"), keys, "_seed")
    gap = feats.select(*keys, F.col("date").alias("last_aaa_date"), F.col("GB_gap").alias("gap_once"))
    start = F.date_add("last_aaa_date", 1)
    out = join_same(join_same(ends, seed, keys, "left"), gap, [*keys, "last_aaa_date"], "left")
    return out.select(
        *keys,
        "last_date",
        "last_aaa_date",
        F.last_day(start).alias("month_end"),
        F.greatest(F.lit(7), F.datediff(F.last_day(start), start) + 1).alias("days"),
        F.coalesce("last_value", F.lit(0.0)).alias("last_value"),
        F.coalesce("slope0", F.lit(0.0)).alias("slope0"),
        F.coalesce("gap_once", F.lit(0.0)).alias("gap_once"),
        "crack_now",
        "stocks_now",
        "refinery_now",
    )


def future_days(starts: DataFrame, keys: list[str]) -> DataFrame:
    return starts.withColumn("h", F.explode(F.sequence(F.lit(1), F.col("days")))).withColumn(
        "date", F.date_add("last_aaa_date", F.col("h"))
    )


def fading_slope() -> Column:
    return F.col("slope0") * F.pow(F.lit(SLOPE_DECAY), (F.col("h") - 1).cast("double"))


def fold_forecast(steps: DataFrame, keys: list[str]) -> DataFrame:
    """y_h = c_h + slope * y_(h-1) along h = 1, 2, ...: columns ``c``, ``carry`` and
    ``last_value`` in, ``yhat`` out. A month and a week bound the array."""
    lists = steps.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("h", "date", "c", "carry"))).alias("_s"),
        F.first("last_value").alias("last_value"),
    )

    def step(acc: Column, s: Column) -> Column:
        y = s["c"] + s["carry"] * acc["y"]
        row = F.struct(s["date"].alias("date"), s["h"].alias("h"), y.alias("yhat"))
        return F.struct(y.alias("y"), F.concat(acc["out"], F.array(row)).alias("out"))

    empty = F.array().cast("array<struct<date:date,h:int,yhat:double>>")
    start = F.struct(F.col("last_value").alias("y"), empty.alias("out"))
    rows = lists.select(*keys, F.explode(F.aggregate("_s", start, step, lambda a: a["out"])).alias("_r"))
    return rows.select(*keys, "_r.date", "_r.h", "_r.yhat")


def recursive_forecast(feats: DataFrame, starts: DataFrame, chosen: DataFrame, keys: list[str], lag: int = 7) -> DataFrame:
    steps = join_same(future_days(starts, keys), chosen.select(*keys, "beta"), keys)
    steps = steps.withColumn("_ref", F.date_sub("date", lag))
    steps = value_at_or_latest(feats.select(*keys, "date", "rb_sm", "wti_sm"), steps, keys, "_ref", ["rb_sm", "wti_sm"])
    b = [F.get("beta", F.lit(i)) for i in range(len(DESIGN))]
    c = (
        b[0]
        + b[2] * fading_slope()
        + b[3] * F.col("rb_sm") * GALLONS_PER_BARREL
        + b[4] * F.col("wti_sm")
        + b[5] * F.col("crack_now")
        + b[7] * F.when(F.col("h") == 1, F.col("gap_once")).otherwise(0.0)
        + b[8] * F.coalesce("stocks_now", F.lit(0.0))
        + b[9] * F.coalesce("refinery_now", F.lit(0.0))
    )
    return fold_forecast(steps.withColumns({"c": c, "carry": b[1]}), keys)


def fallback_forecast(starts: DataFrame, keys: list[str]) -> DataFrame:
    """Last value plus the fading first slope; the steps do not add up."""
    return future_days(starts, keys).select(
        *keys, "date", "h", (F.col("last_value") + fading_slope()).alias("yhat")
    )


def points(forecast: DataFrame, starts: DataFrame, keys: list[str]) -> DataFrame:
    """Forecast on the next Sunday after the panel (else the seventh day) and at
    month end."""
    marks = starts.select(*keys, next_sunday(F.col("last_date")).alias("next_sunday"), "month_end")
    joined = join_same(forecast, marks, keys)
    out = joined.groupBy(*keys, "next_sunday", "month_end").agg(
        F.max(F.when(F.col("date") == F.col("next_sunday"), F.col("yhat"))).alias("_sunday"),
        F.max(F.when(F.col("h") == 7, F.col("yhat"))).alias("_seventh"),
        F.max(F.when(F.col("date") == F.col("month_end"), F.col("yhat"))).alias("eom_point"),
    )
    return out.select(
        *keys, "next_sunday", F.coalesce("_sunday", "_seventh").alias("next_sunday_point"), "month_end", "eom_point"
    )


@dataclass
class Nowcast:
    """Result frames of a fit, one set for all regions."""

    features: DataFrame
    fit: DataFrame
    chosen: DataFrame
    residuals: DataFrame
    starts: DataFrame
    forecast: DataFrame
    points: DataFrame


def nowcast(
    df: DataFrame | None,
    keys: list[str] = ["region"],
    *,
    panel: DataFrame | None = None,
    lookback: int = 180,
    half_life: int = 90,
    tolerance: float = GATE,
    min_rows: int = MIN_ROWS,
    pulse_on: str = "filled",
    holdout: bool = False,
) -> Nowcast:
    """Fit every region; those with fewer than ``min_rows`` training rows get the
    fallback. The features are written once, since all other frames read them."""
    if panel is None:
        panel = daily_panel(df, keys, keep_releases=pulse_on == "release")
    feats = cut_lineage(features(panel, keys, pulse_on=pulse_on))
    fit = with_weight(training_rows(feats, keys, lookback), keys, half_life)
    coefs = solve(gram(fit, keys).filter(F.col("n") >= min_rows), keys)
    judge = None
    if holdout:
        judge = solve(gram(with_tail(fit, keys).filter("not tail"), keys), keys).drop("n")
    chosen = cut_lineage(gate(fit, coefs, keys, tolerance, judge))
    starts = horizon(feats, keys)
    modelled = recursive_forecast(feats, starts, chosen, keys)
    short = join_same(starts, chosen.select(*keys), keys, "left_anti")
    forecast = modelled.unionByName(fallback_forecast(short, keys))
    return Nowcast(
        feats, fit, chosen, residuals(fit, feats, chosen, keys), starts, forecast, points(forecast, starts, keys)
    )


def error_summary(result: Nowcast, keys: list[str]) -> DataFrame:
    """Both errors, whether there were rows enough and whether pulses were used."""
    regions = result.features.select(*keys).distinct()
    out = join_same(regions, result.chosen.select(*keys, "mae_base", "mae_aug", "use_pulses"), keys, "left")
    return out.withColumn("enough_rows", F.col("use_pulses").isNotNull()).withColumn(
        "use_pulses", F.coalesce("use_pulses", F.lit(False))
    )


def exceedance_exact(resid: DataFrame, targets: DataFrame, keys: list[str], point: str, threshold: str) -> DataFrame:
    """Share of residuals above threshold - point: what the bootstrap tends to."""
    extra = [c for c in targets.columns if c not in keys]
    both = join_same(resid.select(*keys, "resid"), targets, keys)
    both = both.withColumn("_sample", F.col(point) + F.col("resid"))
    return exceedance(both, [*keys, *extra], "_sample", F.col(threshold))


def bootstrap(resid: DataFrame, targets: DataFrame, keys: list[str], point: str, draws: int, seed: int) -> DataFrame:
    """Samples point + residual of ``draws`` draws with replacement, as (keys, sample, n):
    how often each residual is drawn. Draw number i picks by the md5 of seed, keys and i,
    so every engine and every rerun draws the same. Residuals are at most one training
    window per region; draws only meet a partial count."""
    pool = resid.groupBy(*keys).agg(F.array_sort(F.collect_list("resid")).alias("_pool"))
    each = join_same(targets.filter(F.col(point).isNotNull()).select(*keys, point), pool, keys)
    sizes = each.select(*keys, F.size("_pool").cast("long").alias("_size"))
    named = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    drawn = sizes.withColumn("_draw", F.explode(F.sequence(F.lit(1), F.lit(draws))))
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *named, F.col("_draw").cast("string")))
    # Fifteen hexadecimal digits are a positive long.
    pick = F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.col("_size"))
    counted = drawn.groupBy(*keys, pick.cast("int").alias("_pick")).agg(F.count(F.lit(1)).alias("n"))
    both = join_same(each, counted, keys)
    return both.select(*keys, (F.col(point) + F.get("_pool", F.col("_pick"))).alias("sample"), "n")


def sample_summary(samples: DataFrame, keys: list[str], threshold: Column | None = None) -> DataFrame:
    """Mean, 5 and 95 percent of samples, and the share above ``threshold`` if given."""
    out = percentiles(samples, keys, "sample", {"p05": 0.05, "p95": 0.95}, "n")
    if threshold is None:
        return out
    above = F.sum(F.when(F.col("sample") > threshold, F.col("n")).otherwise(0)) / F.sum("n")
    return join_same(out, samples.groupBy(*keys).agg(above.alias("probability")), keys)


def threshold_grid(centers: DataFrame, keys: list[str], center: str) -> DataFrame:
    offsets = F.array(*[F.lit(o) for o in OFFSETS])
    return centers.withColumn("_o", F.explode(offsets)).select(
        *keys, F.col(center), (round_to_05(F.col(center)) + F.col("_o")).alias("threshold")
    )


def threshold_table(resid: DataFrame, pts: DataFrame, keys: list[str], point: str = "eom_point") -> DataFrame:
    """Six thresholds around the rounded point with the chance to exceed each."""
    grid = threshold_grid(pts.select(*keys, point).filter(F.col(point).isNotNull()), keys, point)
    out = exceedance_exact(resid, grid, keys, point, "threshold")
    return out.select(
        *keys,
        "threshold",
        "probability",
        money(F.col("threshold"), 2).alias("threshold_text"),
        percent(F.col("probability")).alias("probability_text"),
    )


def sunday_reference(df: DataFrame, feats: DataFrame, keys: list[str], override: float | None = None) -> DataFrame:
    """Value of the last as-of Sunday, else the last day's average; three decimals."""
    last = feats.groupBy(*keys).agg(F.max_by("aaa", "date").alias("_last"))
    sunday = previous_sunday(df.filter(F.col("source") == DAILY_AVG), keys)
    value = F.coalesce(F.lit(override).cast("double"), F.bround(F.coalesce("value", "_last"), 3))
    return join_same(last, sunday, keys, "left").select(*keys, value.alias("reference"))


def sunday_probability(df: DataFrame, result: Nowcast, keys: list[str], override: float | None = None) -> DataFrame:
    """Chance that the next Sunday lies above the last one."""
    targets = join_same(
        result.points.select(*keys, "next_sunday", "next_sunday_point"),
        sunday_reference(df, result.features, keys, override),
        keys,
    )
    return exceedance_exact(result.residuals, targets, keys, "next_sunday_point", "reference")
