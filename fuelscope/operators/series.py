"""Ordered-series functions over a dense daily frame.

``keys`` name the series, ``date`` orders it. A series has one row per calendar
day, which bounds every window partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.arith import soft_clip
from .daily import last_n

PULSE_WEIGHTS = [1.0, 0.6, 0.36, 0.216]
SLOPE_DECAY = 0.70


def by_date(keys: list[str]):
    return W.partitionBy(*keys).orderBy("date")


def forward_fill(df: DataFrame, keys: list[str], *names: str) -> DataFrame:
    past = by_date(keys).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(past) for c in names})


def fill_both(df: DataFrame, keys: list[str], *names: str) -> DataFrame:
    """Forward fill, then the head from the first value. Only rows before the first
    value are still empty then, so one value per series serves all of them; a frame
    that looks ahead from each row would cost the square of the days."""
    past = by_date(keys).rowsBetween(W.unboundedPreceding, 0)
    ahead = by_date(keys).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return df.withColumns(
        {
            c: F.coalesce(
                F.last(c, ignorenulls=True).over(past), F.first(c, ignorenulls=True).over(ahead)
            )
            for c in names
        }
    )


def shift(value: Column, keys: list[str], n: int = 1) -> Column:
    return F.lag(value, n).over(by_date(keys))


def rolling_medians(df: DataFrame, keys: list[str], columns: dict[str, str], half: int = 3, least: int = 3) -> DataFrame:
    """Centred medians over 2*half+1 days where at least ``least`` have a value."""
    frame = by_date(keys).rowsBetween(-half, half)
    return df.withColumns(
        {
            out: F.when(F.count(c).over(frame) >= least, F.percentile(c, F.lit(0.5)).over(frame))
            for c, out in columns.items()
        }
    )


def rolling_median(df: DataFrame, keys: list[str], col: str, out: str, half: int = 3, least: int = 3) -> DataFrame:
    return rolling_medians(df, keys, {col: out}, half, least)


def hampels(
    df: DataFrame, keys: list[str], columns: dict[str, str], half: int = 3, least: int = 3, sigmas: float = 3.0
) -> DataFrame:
    """Replace points further than ``sigmas`` scaled median deviations from the
    rolling median by that median. Several columns share the windows."""
    step = rolling_medians(df, keys, {c: f"_med_{c}" for c in columns}, half, least)
    step = step.withColumns({f"_dev_{c}": F.abs(F.col(c) - F.col(f"_med_{c}")) for c in columns})
    step = rolling_medians(step, keys, {f"_dev_{c}": f"_mad_{c}" for c in columns}, half, least)
    fixed = {
        out: F.when(F.col(f"_dev_{c}") > sigmas * 1.4826 * F.col(f"_mad_{c}"), F.col(f"_med_{c}")).otherwise(F.col(c))
        for c, out in columns.items()
    }
    return step.withColumns(fixed).drop(*[f"_{kind}_{c}" for c in columns for kind in ("med", "dev", "mad")])


def hampel(
    df: DataFrame, keys: list[str], col: str, out: str, half: int = 3, least: int = 3, sigmas: float = 3.0
) -> DataFrame:
    return hampels(df, keys, {col: out}, half, least, sigmas)


def ewms(df: DataFrame, keys: list[str], columns: dict[str, str], span: int) -> DataFrame:
    """Recursive exponential means, alpha = 2/(span+1). Over empty days the weight
    of the past keeps decaying and the output carries forward.

    The recursion y = c * y_before + d unrolls to running products and sums, taken in
    blocks over which the past loses a factor of about e**60; what lies two blocks
    back is below the last bit of a double. So a day costs the same however long its
    series is.
    """
    alpha = 2.0 / (span + 1)
    order = by_date(keys)
    upto = order.rowsBetween(W.unboundedPreceding, 0)
    earlier = order.rowsBetween(W.unboundedPreceding, -1)
    step = df.withColumn("_pos", F.row_number().over(order))
    step = step.withColumns(
        {
            f"_gap_{c}": F.col("_pos")
            - F.last(F.when(F.col(c).isNotNull(), F.col("_pos")), ignorenulls=True).over(earlier)
            for c in columns
        }
    )
    terms = {}
    for c in columns:
        x, gap, here = F.col(c), F.col(f"_gap_{c}"), F.col(c).isNotNull()
        old = F.pow(F.lit(1 - alpha), gap.cast("double"))
        keep = F.greatest(old / (old + alpha), F.lit(1e-26))
        terms[f"_c_{c}"] = F.when(here & gap.isNotNull(), keep).otherwise(1.0)
        terms[f"_d_{c}"] = F.when(here, F.coalesce(alpha * x / (old + alpha), x))
    step = step.withColumns(terms)
    step = step.withColumns({f"_block_{c}": F.floor(F.sum(-F.ln(f"_c_{c}")).over(upto) / 60.0) for c in columns})
    products, sums = {}, {}
    for c in columns:
        block = W.partitionBy(*keys, f"_block_{c}").orderBy("date")
        inside = block.rowsBetween(W.unboundedPreceding, 0)
        products[f"_p_{c}"] = F.product(f"_c_{c}").over(inside)
        products[f"_end_{c}"] = F.lead("_pos").over(block).isNull()
        sums[f"_own_{c}"] = F.col(f"_p_{c}") * F.sum(F.col(f"_d_{c}") / F.col(f"_p_{c}")).over(inside)
    step = step.withColumns(products).withColumns(sums)
    means = {}
    for c, out in columns.items():
        before = F.last(F.when(F.col(f"_end_{c}"), F.col(f"_own_{c}")), ignorenulls=True).over(earlier)
        means[out] = F.col(f"_own_{c}") + F.col(f"_p_{c}") * F.coalesce(before, F.lit(0.0))
    spare = [f"_{kind}_{c}" for c in columns for kind in ("gap", "c", "d", "block", "p", "end", "own")]
    return step.withColumns(means).drop("_pos", *spare)


def ewm(df: DataFrame, keys: list[str], col: str, out: str, span: int) -> DataFrame:
    return ewms(df, keys, {col: out}, span)


def _smooth(df: DataFrame, keys: list[str], columns: dict[str, str], span: int, half: int, least: int) -> DataFrame:
    fixed = {c: f"_fixed_{c}" for c in columns}
    step = hampels(df, keys, fixed, half, least)
    step = ewms(step, keys, {fixed[c]: out for c, out in columns.items()}, span)
    return step.drop(*fixed.values())


def model_smooths(df: DataFrame, keys: list[str], columns: dict[str, str]) -> DataFrame:
    """Hampel repair, mean of span 3, filled both ways."""
    return fill_both(_smooth(df, keys, columns, 3, 3, 3), keys, *columns.values())


def model_smooth(df: DataFrame, keys: list[str], col: str, out: str) -> DataFrame:
    return model_smooths(df, keys, {col: out})


def robust_smooths(df: DataFrame, keys: list[str], columns: dict[str, str], half: int = 3, span: int = 5) -> DataFrame:
    """Hampel repair that always has a median, mean of span 5."""
    return _smooth(df, keys, columns, span, half, 1)


def robust_smooth(df: DataFrame, keys: list[str], col: str, out: str, half: int = 3, span: int = 5) -> DataFrame:
    return robust_smooths(df, keys, {col: out}, half, span)


def pulse(value: Column, keys: list[str], weights: list[float] = PULSE_WEIGHTS) -> Column:
    """Weighted sum of the day and the days before it; nothing counts as zero."""
    total = F.lit(0.0)
    for i, w in enumerate(weights):
        total = total + w * F.coalesce(shift(value, keys, i) if i else value, F.lit(0.0))
    return total


def pulse_projection(
    df: DataFrame, keys: list[str], col: str, out: str, horizon: int, weights: list[float] = PULSE_WEIGHTS
) -> DataFrame:
    """Pulse h days ahead if nothing new is released; zero once the weights end."""
    size = len(weights)
    back = W.partitionBy(*keys).orderBy(F.desc("date"))
    tail = (
        df.withColumn("_back", F.row_number().over(back) - 1)
        .filter(F.col("_back") < size)
        .groupBy(*keys)
        .agg(
            *[
                F.coalesce(F.max(F.when(F.col("_back") == i, F.col(col))), F.lit(0.0)).alias(f"_x{i}")
                for i in range(size)
            ],
            F.max("date").alias("_last"),
        )
    )
    ahead = tail.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    value = F.lit(0.0)
    for i in range(size):
        weight = F.get(F.array(*[F.lit(w) for w in weights]), F.col("h") + i)
        value = value + F.coalesce(weight, F.lit(0.0)) * F.col(f"_x{i}")
    return ahead.select(*keys, "h", F.date_add("_last", F.col("h")).alias("date"), value.alias(out))


def seed_slope(days: DataFrame, keys: list[str], col: str) -> DataFrame:
    """(last - 7th from last) / 7 over non-null days; 0 with fewer than seven."""
    rank = W.partitionBy(*keys).orderBy(F.desc("date"))
    ends = (
        last_n(days, keys, 7, col)
        .withColumn("_rn", F.row_number().over(rank))
        .groupBy(*keys)
        .agg(
            F.max(F.when(F.col("_rn") == 1, F.col(col))).alias("last_value"),
            F.max(F.when(F.col("_rn") == 7, F.col(col))).alias("_seventh"),
        )
    )
    slope = (F.col("last_value") - F.col("_seventh")) / 7.0
    return ends.withColumn("slope0", F.coalesce(slope, F.lit(0.0))).drop("_seventh")


def clipped_slope(df: DataFrame, keys: list[str], col: str, out: str, span: int = 2) -> DataFrame:
    """Seven-day slope of the smoothed series, softly clipped."""
    step = ewm(df, keys, col, "_smooth", span)
    raw = (F.col("_smooth") - shift(F.col("_smooth"), keys, 7)) / 7.0
    return step.withColumn(out, soft_clip(raw)).drop("_smooth")
