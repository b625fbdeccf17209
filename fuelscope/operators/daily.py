"""From raw observations to daily values, and statistics over them.

Every raw aggregate here is partial + final, so a heavy source or day costs one
row per task and group. Windows only see daily rows: at most one per calendar day
of a series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.clock import as_of_by_lag, month_start, ny_date, to_new_york, week_anchor
from ..joins import join_same


def daily_mean(df: DataFrame, keys: list[str], day: Column, value: str = "price", out: str = "price") -> DataFrame:
    return df.groupBy(*keys, day.alias("date")).agg(F.avg(value).alias(out))


def densify(days: DataFrame, keys: list[str]) -> DataFrame:
    """Every calendar day between the first and the last of each key; days that were
    absent have NULL values. Each row is repeated up to the next row's day, so the
    input is read once and nothing is joined."""
    after = F.lead("date").over(W.partitionBy(*keys).orderBy("date"))
    until = F.coalesce(F.date_sub(after, 1), F.col("date"))
    values = [c for c in days.columns if c not in (*keys, "date")]
    known = days.filter(F.col("date").isNotNull()).withColumn("_until", until)
    spread = known.withColumn("_d", F.explode(F.sequence("date", "_until")))
    return spread.select(
        *keys,
        F.col("_d").alias("date"),
        *[F.when(F.col("_d") == F.col("date"), F.col(v)).alias(v) for v in values],
    )


def resample_daily(df: DataFrame, keys: list[str], value: str = "price", out: str = "price") -> DataFrame:
    """Daily mean in New York time with the empty days in between as NULL."""
    return densify(daily_mean(df, keys, ny_date(F.col("scraped_at")), value, out), keys)


def period_averages(df: DataFrame, now: Column, keys: list[str], value: str = "price") -> DataFrame:
    """Rows Daily, Month-to-Date, Week-to-Date per key. ``scraped_at`` in UTC."""
    day = ny_date(F.col("scraped_at"))
    today = ny_date(now)
    wall = to_new_york(F.col("scraped_at"))
    means = df.groupBy(*keys).agg(
        F.avg(F.when(day == today, F.col(value))).alias("d"),
        F.avg(F.when(day >= month_start(today), F.col(value))).alias("m"),
        F.avg(F.when(wall >= week_anchor(now), F.col(value))).alias("w"),
    )
    return means.select(
        *keys,
        F.expr("stack(3, 'Daily (EST)', d, 'Month-to-Date', m, 'Week-to-Date', w) as (period, value)"),
    )


def count_by_source(df: DataFrame) -> DataFrame:
    return df.groupBy("source").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "source")


def date_range(df: DataFrame) -> DataFrame:
    return df.agg(F.min("scraped_at").alias("earliest"), F.max("scraped_at").alias("latest"))


def daily_moves(days: DataFrame, keys: list[str], value: str = "price") -> DataFrame:
    order = W.partitionBy(*keys).orderBy("date")
    return days.withColumn("diff", F.col(value) - F.lag(value).over(order))


def move_sigma(days: DataFrame, keys: list[str], value: str = "price") -> DataFrame:
    """Sample deviation of the daily move and the last value, per key."""
    return (
        daily_moves(days, keys, value)
        .groupBy(*keys)
        .agg(F.stddev_samp("diff").alias("sigma"), F.max_by(value, "date").alias("last_value"))
    )


def sigma_buckets(days: DataFrame, keys: list[str], value: str = "price") -> DataFrame:
    """Per key and k in 3, 2, 1, 0: the move of k sigma, the last value plus and
    minus it, and how many daily moves reach it (k = 0 counts all moves)."""
    moves = daily_moves(days, keys, value)
    # Deviation and moves come from one partitioning by key.
    all_days = W.partitionBy(*keys)
    with_sigma = moves.withColumn("sigma", F.stddev_samp("diff").over(all_days))
    reach = [
        F.count(
            F.when(F.col("sigma").isNull() | F.lit(k == 0) | (F.abs("diff") >= k * F.col("sigma")), F.col("diff"))
        ).alias(f"n{k}")
        for k in (3, 2, 1, 0)
    ]
    one = with_sigma.groupBy(*keys).agg(
        F.max("sigma").alias("sigma"), F.max_by(value, "date").alias("last_value"), *reach
    )
    wide = one.select(
        *keys, "sigma", "last_value", F.expr("stack(4, 3, n3, 2, n2, 1, n1, 0, n0) as (k, occurrences)")
    )
    step = F.col("k") * F.col("sigma")
    return wide.select(
        *keys,
        "k",
        F.abs(step).alias("abs_move"),
        (F.col("last_value") + step).alias("up"),
        (F.col("last_value") - step).alias("down"),
        "occurrences",
    )


# Buckets to a step of the logarithm, and finer ones to a bucket.
COARSE, FINE = 64, 4096


def _height(value: Column) -> Column:
    """A number that never falls as the value rises, with equal steps for equal ratios."""
    high = F.signum(value) * F.log1p(F.abs(value) * 1e6) * COARSE
    return F.when(F.isnan(value), F.lit(1e9)).otherwise(F.least(F.greatest(high, F.lit(-1e8)), F.lit(1e8)))


def percentiles(df: DataFrame, keys: list[str], value: str, shares: dict[str, float], times: str | None = None) -> DataFrame:
    """Exact percentiles by linear interpolation, one row per key, columns named by
    ``shares``; also ``mean``. A row stands for as many as its column ``times`` says.

    Selection by refinement: coarse buckets of value are counted; of the buckets that hold
    a wanted rank the finer ones are counted, and only the values of a finer bucket with
    a wanted rank are counted one by one and put in order. Each level reads the rows again
    and is a partial aggregate, so what is shuffled are counts of buckets, no task holds a
    large group, and the plan runs nothing while built.
    """
    high = _height(F.col(value).cast("double"))
    coarse, fine = F.floor(high).alias("_b"), F.floor((high - F.floor(high)) * FINE).alias("_f")
    k = F.lit(1) if times is None else F.col(times).cast("long")
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"), k.alias("_k"), coarse, fine)
    count = F.sum("_k").alias("_n")

    def ranked(sums: DataFrame, inside: list[str], by: str) -> DataFrame:
        """``sums`` with the rows in front of each, in its group."""
        before = W.partitionBy(*inside).orderBy(by).rowsBetween(W.unboundedPreceding, -1)
        return sums.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))

    def narrowed(sums: DataFrame, wanted: DataFrame, inside: list[str], by: str) -> DataFrame:
        """Where each wanted rank falls, and its rank there."""
        here = join_same(wanted, ranked(sums, inside, by), inside)
        here = here.filter((F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("_n")))
        return here.withColumn("_rank", F.col("_rank") - F.col("_before")).drop("_before", "_n")

    first = rows.groupBy(*keys, "_b").agg(count, F.sum(F.col("_v") * F.col("_k")).alias("_s"))
    totals = first.groupBy(*keys).agg(F.sum("_n").alias("_total"), (F.sum("_s") / F.sum("_n")).alias("mean"))
    at = lambda share: (F.col("_total") - 1) * F.lit(float(share))
    ends = [F.struct(F.lit(f"{name}_{side}").alias("name"), f(at(share)).cast("long").alias("rank")) for name, share in shares.items() for side, f in (("lo", F.floor), ("hi", F.ceil))]
    wanted = totals.select(*keys, F.explode(F.array(*ends)).alias("_e")).select(*keys, F.col("_e.name").alias("_name"), F.col("_e.rank").alias("_rank"))
    wanted = narrowed(first.drop("_s"), wanted, keys, "_b")
    buckets = wanted.select(*keys, "_b").distinct()
    second = join_same(rows, buckets, [*keys, "_b"], "left_semi").groupBy(*keys, "_b", "_f").agg(count)
    wanted = narrowed(second, wanted, [*keys, "_b"], "_f")
    buckets = wanted.select(*keys, "_b", "_f").distinct()
    third = join_same(rows, buckets, [*keys, "_b", "_f"], "left_semi").groupBy(*keys, "_b", "_f", "_v").agg(count)
    found = narrowed(third, wanted, [*keys, "_b", "_f"], "_v")
    names = [f"{name}_{side}" for name in shares for side in ("lo", "hi")]
    found = found.groupBy(*keys).agg(*[F.max(F.when(F.col("_name") == n, F.col("_v"))).alias(f"_{n}") for n in names])
    out = [F.col("mean")]
    for name, share in shares.items():
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        out.append((lo + (hi - lo) * (at(share) - F.floor(at(share)))).alias(name))
    return join_same(totals, found, keys).select(*keys, *out)


def exceedance(df: DataFrame, keys: list[str], value: str, threshold: Column) -> DataFrame:
    above = F.when(F.col(value) > threshold, 1.0).when(F.col(value).isNotNull(), 0.0)
    return df.groupBy(*keys).agg(F.avg(above).alias("probability"))


def last_n(days: DataFrame, keys: list[str], n: int, value: str = "price") -> DataFrame:
    """The last n non-null days of each series."""
    newest = W.partitionBy(*keys).orderBy(F.desc("date"))
    return (
        days.filter(F.col(value).isNotNull())
        .withColumn("_rn", F.row_number().over(newest))
        .filter(F.col("_rn") <= n)
        .drop("_rn")
    )


def trend_line(days: DataFrame, keys: list[str], n: int = 14, value: str = "price") -> DataFrame:
    """Least-squares line over the last n points, at least three. ``intercept`` is
    the value at day number 0 of the proleptic calendar."""
    # Day numbers are centred on the last day before the sums are formed.
    newest = W.partitionBy(*keys)
    x = F.datediff("date", F.max("date").over(newest)).cast("double")
    points = last_n(days, keys, n, value).withColumn("_x", x)
    fit = points.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("points"),
        F.regr_slope(value, "_x").alias("slope"),
        F.regr_intercept(value, "_x").alias("at_last"),
        F.max("date").alias("last_date"),
    )
    ordinal = F.datediff("last_date", F.to_date(F.lit("0001-01-01"))) + 1
    return fit.filter("points >= 3").withColumn(
        "intercept", F.col("at_last") - F.col("slope") * ordinal
    )


def previous_sunday(df: DataFrame, keys: list[str], value: str = "price") -> DataFrame:
    """Mean at the most recent as-of date that is a Sunday."""
    days = daily_mean(df, keys, as_of_by_lag(F.col("scraped_at")), value, value)
    sundays = days.filter(F.weekday("date") == 6)
    return sundays.groupBy(*keys).agg(
        F.max("date").alias("sunday"), F.max_by(value, "date").alias("value")
    )
