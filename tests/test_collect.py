"""The collection job on hand-made pages."""

from datetime import date, datetime

from pyspark.sql import functions as F

from fuelscope.functions.clock import ntz
from fuelscope.operators import extract
from fuelscope.plans.collect import collect, records
from fuelscope.schema import DAILY_AVG, OBSERVATION, RBOB, RETAIL, RUNS, STOCKS, WTI
from fuelscope.sources import observations as stored_rows, sinks

PAGE = "page_id long, source string, html string, read_at timestamp_ntz"
AT = datetime(2025, 8, 25, 3)


def table(*rows):
    return "<table><tbody>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows) + "</tbody></table>"


RELEASE = table(["2025-08-27", "", "", "", "9M", "1M", "1M"], ["2025-08-20", "", "", "", "-2.1M", "1M", "0.5M"])
PAGES = [
    (1, RETAIL, "<p id='tickingAvgPriceText'>$3.15</p>", AT),
    (2, DAILY_AVG, table(["Yesterday Avg.", "$3.0"], ["Current Avg.", "$3.152"]), AT),
    (3, RBOB, '<p class="price">$2.045</p>', AT),
    (4, WTI, '<bg-quote class="value">63.5</bg-quote><time>x</time><span class="timestamp__time">Last Updated: 9 am</span>', AT),
    (5, STOCKS, RELEASE, AT),
    (6, RUNS, RELEASE, AT),
]


def frame(spark, rows=PAGES):
    return spark.createDataFrame(rows, PAGE)


def stored(spark, rows=()):
    return spark.createDataFrame(list(rows), "source string, fuel_type string, price double, scraped_at timestamp_ntz, seq long")


def run(spark, pages, rows=()):
    return collect(frame(spark, pages), stored(spark, rows), ntz("2025-08-25 03:00:00"), F.col("read_at"), F.to_date("read_at"), tie="seq")


def reasons(out):
    return [r["reason"] for r in out.orderBy("page_id").collect()]


def test_all_sources_in_one_frame(spark):
    got = {r["page_id"]: r for r in run(spark, PAGES).collect()}
    assert [got[i]["price"] for i in range(1, 7)] == [3.15, 3.152, 2.045, 63.5, -2.1, -2.1]
    assert [got[i]["label_ts"] for i in range(1, 7)] == ["Unknown", "Current as of 2025-08-24", "Unknown", "9 am", "2025-08-20", "2025-08-20"]
    assert all(r["accepted"] and r["region"] == "United States" for r in got.values())
    assert (got[5]["consensus"], got[5]["surprise"]) == (0.5, -2.6)
    assert (got[6]["consensus"], got[6]["surprise"]) == (None, None)
    assert got[2]["as_of_date"] == date(2025, 8, 23) and got[1]["as_of_date"] is None


def test_equals_the_readers_of_single_sources(spark):
    got = {r["source"]: r["price"] for r in records(frame(spark), F.col("read_at"), F.to_date("read_at")).collect()}
    one = lambda s: frame(spark).filter(F.col("source") == s)
    at = F.col("read_at")
    for good, _ in (
        extract.retail_observations(one(RETAIL), at),
        extract.average_observations(one(DAILY_AVG), at),
        extract.quote_observations(one(RBOB), RBOB, at),
        extract.quote_observations(one(WTI), WTI, at),
        extract.release_observations(one(STOCKS), STOCKS, F.to_date("read_at"), at, True),
    ):
        row = good.first()
        assert got[row["source"]] == row["price"]


def test_one_parse_and_one_scan(spark, tmp_path):
    frame(spark).write.parquet(f"{tmp_path}/pages")
    found = records(spark.read.parquet(f"{tmp_path}/pages"), F.col("read_at"), F.to_date("read_at"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("FileScan") == 1 and "Exchange" not in plan


def test_reasons(spark):
    pages = [
        (1, RETAIL, "<p>loading</p>", AT),
        (2, RETAIL, None, AT),
        (3, DAILY_AVG, "", AT),
        (4, "elsewhere", "<p class='price'>2.0</p>", AT),
        (5, None, "<p class='price'>2.0</p>", AT),
        (6, RBOB, "<p class='price'>2.0</p>", None),
        (7, RBOB, "<p class='price'>2.0</p>", AT),
        (8, WTI, "<p class='price'>60</p>", AT),
        (9, RETAIL, "<p id='tickingAvgPriceText'>$3.15</p>", AT),
        (10, RETAIL, "<p id='tickingAvgPriceText'>$3.15</p>", AT),
        (11, STOCKS, RELEASE, AT),
    ]
    rows = [
        (RBOB, "rbob_futures", 1.0, datetime(2025, 8, 25, 2), 1),
        (WTI, "wti_futures", 20.0, datetime(2025, 8, 18, 3), 2),
        (WTI, "wti_futures", 61.0, datetime(2025, 8, 24), 3),
        (STOCKS, "gasoline_stocks_change", 900.0, AT, 4),
    ]
    want = ["unread", "unread", "unread", "source", "source", "time", "last", "week", None, "copy", "stored"]
    out = run(spark, pages, rows)
    assert reasons(out) == want
    assert [r["price"] is None for r in out.orderBy("page_id").collect()] == [w in ("unread", "source", "time") for w in want]


def test_a_refused_page_does_not_take_the_key(spark):
    pages = [(1, RETAIL, "<p id='tickingAvgPriceText'>$9</p>", AT), (2, RETAIL, "<p id='tickingAvgPriceText'>$3</p>", AT)]
    assert reasons(run(spark, pages, [(RETAIL, "regular_gas", 3.1, datetime(2025, 8, 24), 1)])) == ["last", None]


def test_repeated_pages_and_ids(spark):
    assert sorted(map(str, reasons(run(spark, [PAGES[0]] * 3)))) == ["None", "copy", "copy"]


def test_empty(spark):
    assert run(spark, []).count() == 0


def test_written_in_one_action_and_collected_again(spark, tmp_path):
    pages = [*PAGES, (7, RETAIL, "<p>loading</p>", AT)]
    out = run(spark, pages)
    sinks.append_collected(out, f"{tmp_path}/t")
    table = stored_rows.read_stored(spark, f"{tmp_path}/t/accepted=true")
    assert sorted(r["source"] for r in table.collect()) == sorted(p[1] for p in PAGES)
    assert set(OBSERVATION.fieldNames()) <= set(table.columns)
    again = collect(frame(spark, pages), table, ntz("2025-08-25 03:00:00"), F.col("read_at"), F.to_date("read_at"))
    assert reasons(again) == ["stored"] * 6 + ["unread"]
    back = sinks.read_collected(spark, f"{tmp_path}/t", sinks.stored_types(out).schema)
    assert back.count() == 7 and back.columns == out.columns
