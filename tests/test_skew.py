"""Split keys give the same rows as whole keys and as plain Python."""

import random
import uuid
from bisect import bisect_right
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from fuelscope.operators import daily, lookup, replay
from fuelscope.workload.frames import observations

START = datetime(2024, 1, 1)
SCHEMA = "seq long, source string, price double, scraped_at timestamp_ntz"


def hot_rows(seed=1, n=900, burst=250):
    """One heavy source with one very heavy instant, and some small sources."""
    rnd = random.Random(seed)
    out, seq = [], 0
    for i in range(n):
        at = START + timedelta(minutes=rnd.randrange(60 * 24 * 25))
        source = "hot" if rnd.random() < 0.8 else rnd.choice("abc")
        out.append((seq, source, round(rnd.uniform(1, 3), 2), at))
        seq += 1
    for _ in range(burst):
        out.append((seq, "hot", round(rnd.uniform(1, 3), 2), START + timedelta(days=9)))
        seq += 1
    rnd.shuffle(out)
    return out


def asof_python(rows, lag):
    by = {}
    for seq, source, price, at in rows:
        by.setdefault(source, []).append((at, seq, price))
    for v in by.values():
        v.sort()
    want = {}
    for seq, source, price, at in rows:
        times = [x[0] for x in by[source]]
        i = bisect_right(times, at - lag)
        want[seq] = by[source][i - 1][2] if i else None
    return want


@pytest.mark.parametrize("piece", ["HOUR", "DAY", "YEAR"])
def test_asof_split(spark, piece):
    rows = hot_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    got = lookup.asof(df, df, ["source"], "price", "ref", "7 days", piece=piece)
    assert {r["seq"]: r["ref"] for r in got.collect()} == asof_python(rows, timedelta(days=7))


def test_asof_zero_lag_sees_all_of_the_instant(spark):
    rows = hot_rows(seed=3)
    df = spark.createDataFrame(rows, SCHEMA)
    for piece in ("DAY", "YEAR"):
        got = lookup.asof(df, df, ["source"], "price", "ref", piece=piece)
        assert {r["seq"]: r["ref"] for r in got.collect()} == asof_python(rows, timedelta(0))


def jobs_run(spark, build):
    """Spark jobs that run while ``build`` is called."""
    group = f"building-{uuid.uuid4()}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        build()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_no_job_while_plans_are_built(spark):
    df = spark.createDataFrame(hot_rows(), SCHEMA)
    assert jobs_run(spark, lambda: df.count()) > 0
    assert jobs_run(spark, lambda: lookup.asof(df, df, ["source"], "price", "ref", "7 days")) == 0
    assert jobs_run(spark, lambda: daily.percentiles(df, ["source"], "price", {"p": 0.3})) == 0
    assert jobs_run(spark, lambda: replay.replay_last_only(df, ["source"])) == 0


def test_asof_with_missing_keys_and_times(spark):
    rows = [(0, None, 1.0, START), (1, None, 2.0, START + timedelta(days=3)), (2, "a", 3.0, None), (3, "a", None, START), (4, "a", 5.0, START + timedelta(days=400))]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["seq"]: r["ref"] for r in lookup.asof(df, df, ["source"], "price", "ref", "1 day").collect()}
    assert got == {0: None, 1: 1.0, 2: None, 3: None, 4: None}


@pytest.mark.parametrize("kind", ["normal", "equal", "wide", "close"])
def test_percentiles_of_large_keys(spark, kind):
    rnd = random.Random(5)
    draw = {
        "normal": lambda: rnd.choice([rnd.gauss(0, 1), 0.5, 0.25]),
        "equal": lambda: 3.25,
        "wide": lambda: rnd.choice([-1, 1]) * 10 ** rnd.uniform(-300, 300),
        # Many values of one fine bucket.
        "close": lambda: 1e6 + rnd.random() * 1e-4,
    }[kind]
    rows = [("hot", draw()) for _ in range(1500)] + [("x", 2.0), ("x", 4.0), (None, 1.0), (None, 7.0), ("y", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    shares = {"p00": 0.0, "p05": 0.05, "half": 0.5, "p95": 0.95, "p100": 1.0}
    got = {r["k"]: r for r in daily.percentiles(df, ["k"], "v", shares).collect()}
    assert set(got) == {"hot", "x", None}
    for k in got:
        v = np.sort([r[1] for r in rows if r[0] == k])
        for name, share in shares.items():
            at = (len(v) - 1) * share
            lo, hi = v[int(np.floor(at))], v[int(np.ceil(at))]
            assert got[k][name] == lo + (hi - lo) * (at - np.floor(at))
        assert got[k]["mean"] == pytest.approx(v.mean(), rel=1e-9)


def test_percentiles_of_counted_rows(spark):
    rows = [("a", float(v), n) for v, n in [(1, 3), (2, 1), (5, 4), (9, 0), (7, 2)]]
    got = daily.percentiles(spark.createDataFrame(rows, "k string, v double, n int"), ["k"], "v", {"p30": 0.3, "p95": 0.95}, "n").first()
    flat = np.repeat([r[1] for r in rows], [r[2] for r in rows])
    assert got["p30"] == pytest.approx(np.percentile(flat, 30)) and got["p95"] == pytest.approx(np.percentile(flat, 95)) and got["mean"] == pytest.approx(flat.mean())


def replay_python(rows, limit=0.5, week=True):
    """The collecting job, row by row."""
    state, want = {}, {}
    for seq, source, price, at in sorted(rows, key=lambda r: (r[3], r[0])):
        kept = state.setdefault(source, [])

        def far(ref):
            return ref != 0 and abs((price - ref) / ref) > limit

        ok = not (kept and far(kept[-1][1]))
        if ok and week:
            old = [p for t, p in kept if t <= at - timedelta(days=7)]
            ok = not (old and far(old[-1]))
        want[seq] = ok
        if ok:
            kept.append((at, price))
    return want


@pytest.mark.parametrize("seed, per", [(1, 100), (2, 200), (2, 10**6)])
def test_replay_split(spark, seed, per):
    rows = hot_rows(seed=seed, n=700, burst=90)
    df = spark.createDataFrame(rows, SCHEMA)
    want = replay_python(rows)
    got = replay.replay(df, ["source"], rows_per_segment=per)
    assert {r["seq"]: r["accepted"] for r in got.collect()} == want
    assert 0 < sum(want.values()) < len(want)


@pytest.mark.parametrize("piece", ["HOUR", "DAY", "YEAR"])
def test_replay_last_only_split(spark, piece):
    rows = hot_rows(seed=4, n=700, burst=90)
    df = spark.createDataFrame(rows, SCHEMA)
    got = replay.replay_last_only(df, ["source"], piece=piece)
    assert {r["seq"]: r["accepted"] for r in got.collect()} == replay_python(rows, week=False)


def test_replay_split_on_events(spark, sf_dir):
    """The heavy-tailed given data, all sources hot."""
    df = observations(spark, sf_dir).select("seq", "source", "price", "scraped_at")
    rows = [tuple(r) for r in df.collect()]
    got = replay.replay(df, ["source"], rows_per_segment=100)
    assert {r["seq"]: r["accepted"] for r in got.collect()} == replay_python(rows)


def test_replay_accepts_only_against_accepted(spark):
    prices = [3.00, 9.00, 9.10, 3.10, None]
    rows = [(i, "s", p, START + timedelta(hours=i)) for i, p in enumerate(prices)]
    got = replay.replay(spark.createDataFrame(rows, SCHEMA), ["source"])
    assert [r["accepted"] for r in got.orderBy("seq").collect()] == [True, False, False, True, False]


def test_replay_week_rule_alone_rejects(spark):
    prices = [1.0 * 1.12**i for i in range(11)]
    rows = [(i, "s", p, START + timedelta(days=i)) for i, p in enumerate(prices)]
    df = spark.createDataFrame(rows, SCHEMA)
    by_week = [r["accepted"] for r in replay.replay(df, ["source"]).orderBy("seq").collect()]
    by_last = [r["accepted"] for r in replay.replay_last_only(df, ["source"]).orderBy("seq").collect()]
    assert all(by_last) and by_week[:7] == [True] * 7 and not all(by_week)


def scan_last(prices, last, limit):
    """Flags and leaving price of one piece, row by row."""
    flags = []
    for p in prices:
        ok = p == p and not replay.too_far(p, last, limit)
        flags.append(ok)
        last = p if ok else last
    return flags, last


@pytest.mark.parametrize("limit", [0.5, 0.1, 0.9, 1.5, 0.0])
def test_passage_equals_a_scan_from_every_price(limit):
    rnd = random.Random(11)
    draws = [
        lambda: rnd.uniform(1, 4),
        lambda: rnd.choice([1.1, 2.2, 3.3, 1.65, 0.7, 1.4, 0.0]),
        lambda: rnd.choice([-1, 1]) * 10 ** rnd.uniform(-6, 6),
        lambda: rnd.choice([1.0, float("nan"), float("inf"), -2.0, 0.0, 1.5]),
    ]
    for n in (0, 1, 2, 5, 60):
        for draw in draws:
            for _ in range(12):
                prices = [draw() for _ in range(n)]
                passage = replay.Passage(limit)
                for p in prices:
                    passage.step(p)
                exits = passage.exits()
                edges = [p * f for p in prices if p == p for f in (1, 1 / (1 + limit), 1 + limit, 1 / (1 - limit) if limit != 1 else 1)]
                near = [float(np.nextafter(e, to)) for e in edges[:40] for to in (-np.inf, np.inf)]
                for r in [None, 0.0, *edges, *near, *[draw() for _ in range(20)]]:
                    if r is None or r == r:
                        got = replay.leaving(r, passage.firsts, exits, limit)
                        want = scan_last(prices, r, limit)[1]
                        assert got == want, (prices, r)


def test_passage_keeps_few_states_and_rows():
    rnd = random.Random(3)
    passage = replay.Passage(0.5)
    for _ in range(50_000):
        passage.step(3 * 10 ** rnd.gauss(0, 1))
    assert len(passage.living) < 100 and len(passage.firsts) < 300


def test_replay_last_only_with_many_keys_and_null_prices(spark):
    """Several keys and pieces in one task, batches of a few rows."""
    rng = np.random.default_rng(8)
    rows = [
        (i, [None, "a", "b"][rng.integers(3)], [None, 1, 2][rng.integers(3)], None if i % 13 == 0 else float(rng.choice([1, 1.4, 2, 5])), START + timedelta(hours=int(rng.integers(300))))
        for i in range(900)
    ]
    df = spark.createDataFrame(rows, "seq long, k string, m int, price double, scraped_at timestamp_ntz")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {r["seq"]: r["accepted"] for r in replay.replay_last_only(df, ["k", "m"]).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want, last = {}, {}
    for seq, k, m, p, at in sorted(rows, key=lambda r: (r[4], r[0])):
        ok = p is not None and not replay.too_far(p, last.get((k, m)), 0.5)
        want[seq] = ok
        if ok:
            last[k, m] = p
    assert got == want


@pytest.mark.parametrize("run, sizes", [(replay.replay, [{"rows_per_segment": n} for n in (10_000, 100)]), (replay.replay_last_only, [{"piece": u} for u in ("YEAR", "HOUR")])])
def test_replay_with_missing_keys_and_times(spark, run, sizes):
    """One answer for all sizes of a piece; every row comes back."""
    rng = np.random.default_rng(5)
    start = datetime(2024, 1, 1)
    rows = [(i, ["a", None][i % 2], None if i % 20 == 3 else start + timedelta(hours=int(rng.integers(0, 24 * 14))), float(rng.choice([1.0, 1.2, 3.0]))) for i in range(400)]
    df = spark.createDataFrame(rows, "seq long, k string, scraped_at timestamp_ntz, price double")
    answers = [{r["seq"]: r["accepted"] for r in run(df, ["k"], **size).collect()} for size in sizes]
    assert answers[0] == answers[1] and len(answers[0]) == len(rows)
    assert not any(answers[0][r[0]] for r in rows if r[2] is None)


def test_replay_streams_over_many_keys(spark):
    """Keys of a task follow each other, and other columns pass through as they are."""
    start = datetime(2024, 1, 1)
    rows = [(2**60 + 2 * i + 1 if i % 5 else None, f"s{i % 300}", 1.0 + i * 7 % 13 / 4, start + timedelta(hours=i)) for i in range(3_000)]
    df = spark.createDataFrame(rows, "seq long, source string, price double, scraped_at timestamp_ntz")
    out = replay.replay(df, ["source"])
    assert "FlatMapGroups" not in out._jdf.queryExecution().toString()
    got = {(r["seq"], r["scraped_at"]): r["accepted"] for r in out.collect()}
    want = replay_python([(i, source, price, time) for i, (_, source, price, time) in enumerate(rows)])
    assert got == {(seq, time): want[i] for i, (seq, _, _, time) in enumerate(rows)}


def test_weeks_of_a_large_key_take_the_same_passes(spark, monkeypatch):
    """Three tables are written for each week, whatever the prices."""
    start = datetime(2024, 1, 1)
    rows = [(i, "s", 1.0 + i * 37 % 101 / 9, start + timedelta(hours=i)) for i in range(21 * 24)]
    df = spark.createDataFrame(rows, "seq long, source string, price double, scraped_at timestamp_ntz")
    written, cut = [], replay.cut_lineage
    monkeypatch.setattr(replay, "cut_lineage", lambda frame: written.append(1) or cut(frame))
    got = replay.replay(df, ["source"], rows_per_segment=100)
    assert {r["seq"]: r["accepted"] for r in got.collect()} == replay_python(rows)
    assert len(written) == 9
