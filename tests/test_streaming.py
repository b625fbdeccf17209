"""Streaming jobs over split files equal their batch twins."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fuelscope.functions.clock import ny_date
from fuelscope.operators import daily, lookup
from fuelscope.operators.replay import replay
from fuelscope.session import new_folder
from fuelscope.streaming import generations, jobs
from fuelscope.workload.frames import observations


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    """Observations in five files in order of time."""
    import os

    path = tmp_path_factory.mktemp("in")
    df = observations(spark, "/root/testdata/sf0.001").cache()
    n = df.count()
    for i in range(5):
        part = df.filter((F.col("seq") >= i * n // 5) & (F.col("seq") < (i + 1) * n // 5)).coalesce(1)
        part.write.mode("append").parquet(str(path))
        for f in path.glob("part-*"):
            if not f.name.startswith("part-done"):
                f.rename(path / f"part-done-{i}.parquet")
                os.utime(path / f"part-done-{i}.parquet", (1_700_000_000 + i * 60, 1_700_000_000 + i * 60))
    return str(path), df


def same(a, b):
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def read(spark, files):
    path, df = files
    return jobs.read_stream(spark, path, df.schema, "part-done-*.parquet", 1)


def test_distinct_ingest(spark, files):
    folder = new_folder(spark, "t")
    out = jobs.distinct_ingest(read(spark, files).unionByName(read(spark, files)))
    jobs.run_append(out, folder)
    same(spark.read.schema(out.schema).parquet(f"{folder}/out"), files[1])


def test_screen_equals_replay(spark, files):
    folder = new_folder(spark, "t")
    columns = ["seq", "source", "price", "scraped_at"]
    got = jobs.run_screen(read(spark, files).select(*columns), folder, ["source"], delay="3650 days")
    assert got.where("late").count() == 0
    got = got.select("seq", "accepted")
    same(got, replay(files[1].select(*columns), ["source"]).select("seq", "accepted"))


def test_daily_mean(spark, files):
    folder = new_folder(spark, "t")
    out = jobs.daily_mean_stream(read(spark, files), ["source"])
    query = jobs.run_update(out, folder, ["source", "date"])
    assert jobs.late_rows(query) == 0
    got = jobs.current_rows(spark, folder, out.schema).withColumn("price", F.round("price", 6))
    want = daily.daily_mean(files[1], ["source"], ny_date(F.col("scraped_at"))).withColumn("price", F.round("price", 6))
    same(got.select("source", "date", "price"), want)


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    schema = "source string, price double, scraped_at timestamp_ntz"
    start = datetime(2024, 5, 1, 12)
    steps = [[(start, 1.0)], [(start + timedelta(days=30), 2.0)], [(start, 9.0), (start + timedelta(days=30), 4.0)]]
    folder = str(tmp_path / "run")
    dropped = 0
    for i, step in enumerate(steps):
        spark.createDataFrame([("s", p, t) for t, p in step], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = jobs.read_stream(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema, "*.parquet")
        days = jobs.daily_mean_stream(stream, ["source"])
        dropped += jobs.late_rows(jobs.run_update(days, folder, ["source", "date"]))
    got = {str(r["date"]): r["price"] for r in jobs.current_rows(spark, folder, days.schema).collect()}
    assert got == {"2024-05-01": 1.0, "2024-05-31": 3.0} and dropped == 1


def test_latest(spark, files):
    folder = new_folder(spark, "t")
    out = jobs.latest_stream(read(spark, files), ["source"])
    jobs.run_update(out, folder, ["source"])
    same(jobs.current_rows(spark, folder, out.schema), lookup.latest_value(files[1], ["source"], tie="seq"))


def arrived(spark, folder, steps):
    """A stream of one file a step, of (seq, price, day)."""
    schema = "seq long, source string, price double, scraped_at timestamp_ntz"
    start = datetime(2024, 5, 1)
    for step in steps:
        rows = [(seq, "s", price, start + timedelta(days=day)) for seq, price, day in step]
        one = spark.createDataFrame(rows, schema)
        one.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    return jobs.read_stream(spark, f"{folder}/in", one.schema, "*.parquet", 1)


def test_old_reference_outlives_the_week(spark, tmp_path):
    """An accepted price stays the week-old reference until a newer one is old."""
    steps = [[(0, 1.0, 0)], [(1, 1.4, 20)], [(2, 1.6, 21)], [(3, 1.45, 22)], [(4, 2.0, 40)]]
    out = jobs.run_screen(arrived(spark, str(tmp_path), steps), str(tmp_path / "run"), ["source"])
    got = [r["accepted"] for r in out.orderBy("seq").collect()]
    assert got == [True, True, False, True, True]


def test_screen_in_order_of_time_whatever_the_arrival(spark, tmp_path):
    """Rows of an earlier time in a later file are judged first, and change later flags."""
    steps = [[(2, 2.0, 2), (1, 1.7, 1)], [(0, 1.0, 0)], [(5, 1.2, 5)], [(3, 1.1, 3), (4, float("nan"), 4)]]
    out = jobs.run_screen(arrived(spark, str(tmp_path), steps), str(tmp_path / "run"), ["source"])
    got = [tuple(r) for r in out.orderBy("seq").select("seq", "accepted", "late").collect()]
    batch = replay(spark.read.parquet(f"{tmp_path}/in"), ["source"]).orderBy("seq").select("seq", "accepted").collect()
    assert got == [(r["seq"], r["accepted"], False) for r in batch]
    assert [f for _, f, _ in got] == [True, False, False, True, False, True]


def test_rows_behind_the_watermark_are_an_output_of_their_own(spark, tmp_path):
    """What comes too late is neither judged nor lost, and changes no flag."""
    steps = [[(0, 1.0, 0)], [(1, 1.2, 30)], [(2, 9.0, 31), (3, 0.1, 2)], [(4, 1.3, 32), (5, 1.25, 29)]]
    out = jobs.run_screen(arrived(spark, str(tmp_path), steps), str(tmp_path / "run"), ["source"])
    got = {r["seq"]: (r["accepted"], r["late"]) for r in out.collect()}
    assert got == {0: (True, False), 1: (True, False), 2: (False, False), 3: (None, True), 4: (True, False), 5: (True, False)}
    assert spark.read.parquet(f"{tmp_path}/run/out/late=true").count() == 1


KEYED = "source string, day int, price double"


def test_generations_replace_rows_of_equal_keys(spark, tmp_path):
    folder = str(tmp_path)
    frame = lambda *rows: spark.createDataFrame(rows, KEYED)
    read = lambda: sorted(map(str, (tuple(r) for r in generations.current(spark, folder, frame(("a", 1, 1.0)).schema).collect())))
    assert read() == []
    generations.merge(frame(("a", 1, 1.0), (None, 1, 2.0), ("b", None, 3.0)), 0, folder, ["source", "day"], 4)
    generations.merge(frame(("a", 2, 4.0), (None, 1, 5.0)), 1, folder, ["source", "day"], 4)
    want = sorted(map(str, [("a", 1, 1.0), ("a", 2, 4.0), (None, 1, 5.0), ("b", None, 3.0)]))
    assert read() == want
    generations.merge(frame(("a", 2, 4.0), (None, 1, 5.0)), 1, folder, ["source", "day"], 4)
    assert read() == want
    generations.merge(frame(("a", 1, 0.0)).limit(0), 2, folder, ["source", "day"], 4)
    assert read() == want


def test_a_batch_that_was_not_published_is_not_seen(spark, tmp_path):
    folder = str(tmp_path)
    generations.merge(spark.createDataFrame([("a", 1, 1.0)], KEYED), 0, folder, ["source"], 4)
    done = {p.name for p in tmp_path.glob("data/batch=0/*")}
    generations.merge(spark.createDataFrame([("a", 1, 2.0)], KEYED), 1, folder, ["source"], 4)
    (tmp_path / "lists/generation=1/_SUCCESS").unlink()
    assert done and [r["price"] for r in generations.current(spark, folder, spark.createDataFrame([], KEYED).schema).collect()] == [1.0]
    generations.merge(spark.createDataFrame([("a", 1, 2.0)], KEYED), 1, folder, ["source"], 4)
    assert [r["price"] for r in generations.current(spark, folder, spark.createDataFrame([], KEYED).schema).collect()] == [2.0]


def test_only_two_generations_stay(spark, tmp_path):
    for n in range(5):
        generations.merge(spark.createDataFrame([("a", n % 2, float(n))], KEYED), n, str(tmp_path), ["day"], 8)
    assert len(list(tmp_path.glob("lists/generation=*"))) == 2
    assert len(list(tmp_path.glob("data/batch=*"))) <= 3
    got = generations.current(spark, str(tmp_path), spark.createDataFrame([], KEYED).schema).orderBy("day").collect()
    assert [r["price"] for r in got] == [4.0, 3.0]


def test_ingest_reads_only_the_days_of_the_batch(spark, tmp_path):
    """Copies of stored rows are refused however old; files of other days are not needed."""
    steps = [[(0, 1.0, 0), (1, 2.0, 100)], [(2, 1.0, 0), (3, 3.0, 200)]]
    stream = arrived(spark, str(tmp_path), steps)
    jobs.run_ingest(stream, str(tmp_path / "run"), ["source", "scraped_at"])
    stored = spark.read.parquet(f"{tmp_path}/run/out")
    assert sorted(r["seq"] for r in stored.collect()) == [0, 1, 3]
    for f in tmp_path.glob("run/out/part=2024-08-09/batch=0/part-*"):
        f.write_bytes(b"not a file of the table")
    more = arrived(spark, str(tmp_path), [[(4, 1.0, 0), (5, 9.0, 200), (6, 9.0, 201)]])
    jobs.run_ingest(more, str(tmp_path / "run"), ["source", "scraped_at"])
    new = spark.read.parquet(f"{tmp_path}/run/out/part=2024-11-18")
    assert [r["seq"] for r in new.collect()] == [6]


def test_screen_of_many_keys_in_few_groups(spark, tmp_path):
    """Keys share groups of state and are judged apart; a missing key is one of its own."""
    schema = "seq long, region string, source string, price double, scraped_at timestamp_ntz"
    start = datetime(2024, 5, 1)
    keys = [(r, s) for r in ["a", "b", None] for s in ["x", "y", None]]
    for k in range(3):
        rows = [(i * 90 + j * 10 + d + k * 3, *key, 1.0 + (i * 7 + j * 5 + d * 3) % 11 / 5, start + timedelta(days=d + k * 3)) for i in [0] for j, key in enumerate(keys) for d in range(3)]
        one = spark.createDataFrame(rows, schema)
        one.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = jobs.read_stream(spark, f"{tmp_path}/in", one.schema, "*.parquet", 1)
    out = jobs.run_screen(stream, str(tmp_path / "run"), ["region", "source"], delay="4 days", buckets=2)
    got = {r["seq"]: r["accepted"] for r in out.collect()}
    batch = {r["seq"]: r["accepted"] for r in replay(spark.read.parquet(f"{tmp_path}/in"), ["region", "source"]).collect()}
    assert len(batch) == 81 and got == batch and len(set(got.values())) == 2
