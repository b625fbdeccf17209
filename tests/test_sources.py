"""Files in and out, schema checks, import clean-up."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fuelscope import schema
from fuelscope.functions.clock import ntz
from fuelscope.plans.imports import clean_import
from fuelscope.sources import observations as src
from fuelscope.sources import sinks
from fuelscope.sources.pages import read_pages

NOW = "2025-09-10 00:00:00"
CSV = """source,fuel_type,price,timestamp,region,scraped_at
gasbuddy_fuel_insights,Regular,3.147,x,United States,9/2/2025 12:25:02 AM
gasbuddy_fuel_insights,regular_gas ,9.999,x,United States,9/2/2025 12:25:02 AM
aaa_gas_prices,regular,3.152,Current as of 2025-08-24,,whatever
marketwatch_rbob_futures,rbob_futures,oops,2025-09-02 10:00:00 EDT,United States,
tradingeconomics_gasoline_stocks,gasoline_stocks_change,-1.5,2025-08-20,United States,
 NaN ,x,1,,,
gasbuddy_fuel_insights,,1,,,soon
gasbuddy_fuel_insights,regular,3.2,x,United States,soon
"""


@pytest.fixture
def raw(spark, tmp_path):
    path = tmp_path / "drop.csv"
    path.write_text(CSV)
    return src.read_csv(spark, str(path))


def test_csv_completes_columns(raw):
    assert raw.columns == schema.COLUMNS[:2] + ["price", "label_ts", "region", "consensus", "surprise", "scraped_at", "as_of_date", "seq"]
    assert raw.filter("consensus is not null or as_of_date is not null").isEmpty()
    assert raw.filter("region is null").count() == 3


def test_import(raw):
    out, counts = clean_import(raw, ntz(NOW))
    rows = {(r["source"], r["price"]): r for r in out.collect()}
    assert {n: c.get["rows"] for n, c in counts.items()} == {"read": 8, "named": 6, "kept": 5}
    retail = rows[("gasbuddy_fuel_insights", 3.147)]
    assert retail["fuel_type"] == "regular_gas" and retail["scraped_at"] == datetime(2025, 9, 2, 4, 25, 2)
    average = rows[("aaa_gas_prices", 3.152)]
    assert average["scraped_at"] == datetime(2025, 8, 24, 12) and average["as_of_date"] == date(2025, 8, 24)
    assert average["region"] is None
    assert rows[("marketwatch_rbob_futures", None)]["scraped_at"] == datetime(2025, 9, 2, 14)
    assert rows[("tradingeconomics_gasoline_stocks", -1.5)]["scraped_at"] == datetime(2025, 8, 20, 4)
    assert rows[("gasbuddy_fuel_insights", 3.2)]["scraped_at"] == datetime(2025, 9, 10)


def test_import_can_reject_bad_times(raw):
    out, _ = clean_import(raw, ntz(NOW), on_bad_time="reject")
    assert out.count() == 4 and out.filter(F.col("price") == 3.2).isEmpty()


def test_first_in_file_order_over_many_blocks(spark, tmp_path):
    lines = ["source,fuel_type,price,timestamp,region,consensus,surprise,scraped_at,as_of_date"]
    for i in range(4000):
        lines.append(f"gasbuddy_fuel_insights,regular,{i}.5,,US,,,9/2/2025 {1 + i % 12}:00:00 AM,")
    path = tmp_path / "big.csv"
    path.write_text("\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        raw = src.read_csv(spark, str(path))
        assert raw.rdd.getNumPartitions() > 4
        out, _ = clean_import(raw, ntz(NOW))
        assert sorted(r["price"] for r in out.collect()) == [i + 0.5 for i in range(12)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def batch(spark, n=3, at=None):
    rows = [(schema.RETAIL, "regular_gas", 3.0 + i, "x", "US") for i in range(n)]
    return spark.createDataFrame(rows, "source string, fuel_type string, price double, label_ts string, region string")


def test_append_replace_and_evolve(spark, tmp_path):
    path = str(tmp_path / "table")
    assert not sinks.append(batch(spark, 0), path, ntz(NOW))
    assert sinks.append(batch(spark), path, ntz(NOW))
    extra = batch(spark).withColumn("consensus", F.lit(1.25))
    assert sinks.append(extra, path, ntz("2025-09-11 01:00:00"))
    stored = src.read_stored(spark, path)
    assert stored.count() == 6 and stored.select("scraped_at").distinct().count() == 2
    assert [str(r[0]) for r in stored.select("consensus").distinct().orderBy("consensus").collect()] == ["None", "1.2500"]
    blank = batch(spark, 2).withColumn("region", F.lit("")).withColumn("scraped_at", ntz(NOW))
    sinks.replace(blank, path)
    assert src.read_stored(spark, path).filter("region is null").count() == 2
    assert sinks.evolve(batch(spark)).dtypes[-3:] == [("consensus", "double"), ("surprise", "double"), ("as_of_date", "date")]


def test_old_files_without_later_columns(spark, tmp_path):
    path = str(tmp_path / "old")
    old = schema.conform(batch(spark).withColumn("scraped_at", ntz(NOW))).drop(*schema.OPTIONAL_COLUMNS)
    old.write.parquet(path)
    stored = src.read_stored(spark, path)
    assert stored.columns == schema.COLUMNS and stored.filter("as_of_date is not null").isEmpty()


def test_nan_becomes_null_and_ids_follow_the_key(spark):
    df = spark.createDataFrame([(schema.RETAIL, float("nan"), NOW), (schema.RETAIL, 1.0, NOW)], "source string, price double, scraped_at string")
    out = schema.conform(df)
    assert out.filter("price is null").count() == 1
    assert out.select(schema.observation_id().alias("id")).distinct().count() == 1
    assert dict(schema.as_double(out).dtypes)["price"] == "double"


def stored_rows(spark):
    today = datetime(2025, 9, 2, 3)
    rows = [
        (schema.RETAIL, 1.0, today), (schema.STOCKS, 2.0, today), (schema.RETAIL, 3.0, today - timedelta(days=1)),
        (schema.RETAIL, 4.0, today - timedelta(days=2)), (schema.RETAIL, 5.0, today + timedelta(days=2)),
    ]
    df = spark.createDataFrame(rows, "source string, price double, scraped_at timestamp_ntz")
    return schema.conform(df).withColumns({"consensus": F.lit(1.0), "surprise": F.lit(2.0)})


def test_backup_writes_one_folder_per_slice(spark, tmp_path):
    path = tmp_path / "backup"
    sinks.write_backup(stored_rows(spark), str(path), date(2025, 9, 2))
    back = spark.read.option("header", True).csv(str(path))
    got = {r["slice"]: r["n"] for r in back.groupBy("slice").agg(F.count("*").alias("n")).collect()}
    assert got == {"today": 2, "yesterday": 1, "month": 4}
    sinks.write_backup(stored_rows(spark).filter("price = 4"), str(path), date(2025, 9, 30))
    assert not [p for p in path.iterdir() if p.name.startswith("slice")]


def test_reports(spark, tmp_path):
    today = F.to_date(F.lit("2025-09-02"))
    day = sinks.daily_report(stored_rows(spark), today)
    assert sorted(float(r["price"]) for r in day.collect()) == [1.0, 2.0]
    assert [(r["consensus"], r["surprise"]) for r in day.orderBy("price").collect()] == [(None, None), (1.0, 2.0)]
    month = sinks.monthly_report(stored_rows(spark), today)
    assert sorted(float(r["price"]) for r in month.collect()) == [1.0, 2.0, 3.0, 5.0]
    sinks.write_report(month, str(tmp_path / "report"))
    assert {p.name for p in (tmp_path / "report").iterdir() if p.is_dir()} == {f"source={schema.RETAIL}", f"source={schema.STOCKS}"}


def test_export_is_newest_first(spark, tmp_path):
    path = str(tmp_path / "export")
    sinks.export_csv(stored_rows(spark).drop("consensus"), path)
    parts = sorted((tmp_path / "export").glob("part-*.csv"))
    lines = [line for p in parts for line in p.read_text().splitlines()]
    heads = [line for line in lines if line.startswith("source,")]
    assert heads[0] == "source,fuel_type,price,label_ts,region,scraped_at,surprise,as_of_date"
    times = [line.split(",")[5] for line in lines if not line.startswith("source,")]
    assert times == sorted(times, reverse=True) and len(times) == 5


def test_schema_checks(spark, tmp_path):
    rows = src.describe_schema(schema.conform(batch(spark).withColumn("scraped_at", ntz(NOW)))).collect()
    assert [(r["column_name"], r["data_type"]) for r in rows][2] == ("price", "decimal(10,4)")
    sizes = {(r["column_name"], r["n_rows"], r["n_values"]) for r in src.describe_schema(spark.createDataFrame([(1, None), (2, "x"), (3, None)], "`a.b` int, c string")).collect()}
    assert sizes == {("a.b", 3, 3), ("c", 3, 1)}
    good = stored_rows(spark).select(*schema.BASE_COLUMNS)
    problems = {(r["column_name"], r["problem"], r["n"]) for r in src.contract_violations(good).collect()}
    assert problems == {("consensus", "missing", 1), ("surprise", "missing", 1), ("as_of_date", "missing", 1)}
    bad = schema.conform(spark.createDataFrame([(None, 1.0, NOW), ("a", 1.0, None)], "source string, price double, scraped_at string"))
    problems = {(r["column_name"], r["problem"], r["n"]) for r in src.contract_violations(bad).collect()}
    assert problems == {("source", "null", 1), ("scraped_at", "null", 1)}
    assert not src.table_ready(spark, "no_such_table")
    good.createOrReplaceTempView("there")
    assert src.table_ready(spark, "there")


def test_time_slices_cover_everything():
    text = src.time_slices("t", datetime(2024, 1, 1), datetime(2024, 1, 2, 12), timedelta(days=1))
    assert len(text) == 5
    assert text[0] == "t < '2024-01-01 00:00:00'" and text[2] == "t is null"
    assert text[3:] == [
        "t >= '2024-01-01 00:00:00' and t < '2024-01-02 00:00:00'",
        "t >= '2024-01-02 00:00:00' and t < '2024-01-02 12:00:00'",
    ]


def test_pages_by_address(spark, tmp_path):
    rows = [(1, "https://gasprices.aaa.com/", "<p>"), (2, "https://www.marketwatch.com/investing/future/cl.1?x", ""), (3, "https://x.example", "")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "p"))
    got = {r["page_id"]: r["source"] for r in read_pages(spark, str(tmp_path / "p")).collect()}
    assert got == {1: schema.DAILY_AVG, 2: schema.WTI}


def test_recent_filter_reaches_the_scan(spark, sf_dir, capsys):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumnRenamed("ts", "scraped_at")
    src.recent(events.select("scraped_at", "value"), ntz("2024-01-30 18:00:00"), 14).explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(ts,2024-01-16" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in plan
