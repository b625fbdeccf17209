"""Plans keep the shape that scales."""

import pytest
from pyspark.sql import functions as F

from fuelscope.operators import daily, lookup
from fuelscope.plans.panel import daily_panel
from fuelscope.plans.reports import crack_series
from fuelscope.schema import RBOB, WTI
from fuelscope.sources import observations as src
from fuelscope.sources import sinks
from fuelscope.functions.clock import ntz
from fuelscope.workload import QUERIES
from fuelscope.workload.frames import observations


@pytest.fixture
def plan(capsys):
    def text(df):
        capsys.readouterr()
        df.explain("formatted")
        return capsys.readouterr().out

    return text


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory, sf_dir):
    path = str(tmp_path_factory.mktemp("stored") / "table")
    sinks.replace(observations(spark, sf_dir), path)
    return spark.read.parquet(path)


def operators(text):
    return [line.split(")")[1].strip() for line in text.splitlines() if line.startswith("(") and ")" in line]


def test_top_rows_are_limited_before_the_shuffle(spark, sf_dir, plan):
    text = plan(lookup.keep_first(observations(spark, sf_dir), ["source", "fuel_type", "scraped_at"], "seq"))
    assert operators(text).count("WindowGroupLimit") == 2


def test_latest_rows_do_not_shuffle_the_table(spark, sf_dir, plan):
    text = plan(lookup.latest_rows(observations(spark, sf_dir), ["source"]))
    assert "BroadcastHashJoin LeftSemi" in text and "SortMergeJoin" not in text
    assert "Exchange" not in [op for op in operators(text)]


def test_only_needed_sources_and_columns_are_read(stored, plan):
    text = plan(crack_series(stored, []))
    assert "PartitionFilters: [" in text and f"source#" in text and RBOB in text and WTI in text
    assert "ReadSchema: struct<price:decimal(10,4),scraped_at:timestamp_ntz>" in text


def test_daily_mean_combines_before_the_shuffle(spark, sf_dir, plan):
    ops = operators(plan(daily.daily_mean(observations(spark, sf_dir), ["source"], F.to_date("scraped_at"))))
    assert ops.count("HashAggregate") == 2 and ops.count("Exchange") == 1


def test_last_price_needs_no_sort(spark, sf_dir, plan):
    ops = operators(plan(lookup.latest_value(observations(spark, sf_dir), ["source"])))
    assert ops.count("HashAggregate") == 2 and "Sort" not in ops


def test_panel_reads_the_table_once_per_kind_and_joins_nothing(spark, sf_dir, plan):
    text = plan(daily_panel(observations(spark, sf_dir)))
    ops = operators(text)
    assert sum(op.startswith("Scan parquet") for op in ops) == 2
    assert "Join" not in text and ops.count("Exchange") <= 4


@pytest.mark.parametrize("name", ["a5_insert_if_absent", "d4_as_of_7_days", "e9_sigma_buckets", "e17_coverage", "i12_crack_spread", "i14_screen_batch", "i17_kpis"])
def test_no_cross_joins(spark, sf_dir, plan, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_retail_window_filter_is_pushed(stored, plan):
    text = plan(src.recent(stored.select("source", "price", "scraped_at"), ntz("2024-01-30 18:00:00"), 7))
    assert "GreaterThanOrEqual(scraped_at,2024-01-23" in text
