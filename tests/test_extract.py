"""Page readers on hand-made pages."""

import time
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from fuelscope.functions.clock import ntz
from fuelscope.operators import extract, html
from fuelscope.operators.html import first_texts, table_rows
from fuelscope.schema import DAILY_AVG, RBOB, RUNS, STOCKS


def pages(spark, *html):
    return spark.createDataFrame(list(enumerate(html)), "page_id long, html string")


def table(*rows):
    return "<table><tbody>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows) + "</tbody></table>"


def test_page_ends():
    text = lambda page: html.parse(page)[0].text()
    assert text("<p>a <b>b</b> c") == "a b c"
    assert text("<p>a <!-- x > y") == "a"
    assert text("<p>a <script>1 > 0; y") == "a"
    assert text("<p>a <!-- x --> y") == "a y"
    assert text("<p>a <!-- x --> y <!-- z") == "a y"
    assert text("<p>a <b y") == "a <b y"
    assert text("<p>a <!doctype x> y") == "a y"
    assert [n.text() for n in html.parse("<html><head><title>t</title><body>b")] == ["b", "b", "t", "b"]


@pytest.mark.parametrize("piece", ["<b>some text", "<a ", "<li><b>x", "</i><b>y", "<a \"", "<p></p><b>"])
def test_page_reader_is_linear(piece):
    start = time.perf_counter()
    nodes = html.parse("<title>t</title><p>" + piece * 200_000)
    assert time.perf_counter() - start < 8
    assert nodes[0].text() == "t"


def test_selectors():
    html = """<html><head><title>T &amp; t</title></head><body class="a b"><h2 class="intraday__price x">
      <sup>$</sup><bg-quote class="value">2,045.1</bg-quote></h2><p class=price>one<p class=price>two
      <span data-field="last">9</span><script>var price = "<p class='price'>no</p>";</script>
      <div data-bind="text: tickingAvgLastUpdated, x"> now <br>then </div><td id=actual>5</td></body></html>"""
    got = first_texts(
        html,
        ["bg-quote.value", "h2.intraday__price .value", ".price", "span[data-field='last']", "div[data-bind*='tickingAvg']",
         "#actual", "title", ".missing", "body.a.b h2", "p .value"],
    )
    assert got == ["2,045.1", "2,045.1", "one", "9", "now then", "5", "T & t", None, "$2,045.1", None]
    assert first_texts(None, ["p"]) == [None]


def test_rows_with_unclosed_cells():
    html = "<table><thead><tr><td>head</td></tr></thead><tbody><tr><td>a<td id=actual>b<tr><td><b>c</b> d</table>"
    assert [(r["row_idx"], r["cells"], r["ids"]) for r in table_rows(html)] == [
        (0, ["a", "b"], ["", "actual"]),
        (1, ["c d"], [""]),
    ]


def test_labelled_price(spark):
    found = extract.labelled_price(
        pages(
            spark,
            table(["Regular"], ["Current Avg.", "$3.152", "$4"], ["Current Avg.", "$9"]),
            table(["Current Avg.", "$1"]),
            table(["Yesterday Avg.", "$3.152"], ["Current Avg."]),
            "",
        )
    )
    assert [r["price_text"] for r in found.orderBy("page_id").collect()] == ["$3.152", None, None, None]


def test_quote_priority_and_defaults(spark):
    html = [
        '<p class="price"> </p><p data-testid="price">$2.1</p><p class="timestamp">Last Updated: Sep 2</p>',
        '<p class="price">$1,234.5</p>',
        '<p class="timestamp">Sep 2</p>',
    ]
    got = [(r["price_text"], r["label"]) for r in extract.quote(pages(spark, *html)).orderBy("page_id").collect()]
    assert got == [("$2.1", "Sep 2"), ("$1,234.5", "Unknown"), (None, None)]
    digits = extract.quote(
        pages(spark, '<p class="price">n/a</p><p class="value">7</p>'), extract.ADAPTER_PRICE, extract.ADAPTER_LABEL, True
    )
    assert digits.first()["price_text"] == "7"


RELEASES = [
    ["2099-01-01", "", "", "", "9M", "8M", "7M"],
    ["2025-08-20", "", "", "", "", "8M", "7M"],
    ["2025-08-13", "", "", "", "-2.1M", "1M", ""],
    ["2025-08-20", "", "", "", "1M", "8M"],
    ["2025-08-13", "", "", "", "5M", "1M", "2M"],
    ["2025-8-6", "", "", "", "4M", "1M", "2M"],
]


def test_nearest_release(spark):
    got = extract.nearest_release(pages(spark, table(*RELEASES), table(RELEASES[0])), F.lit(date(2025, 8, 21))).collect()
    assert [(r["page_id"], r["date"], r["actual"], r["previous"], r["consensus"], r["surprise"]) for r in got] == [
        (0, date(2025, 8, 13), -2.1, 1.0, 0.0, -2.1)
    ]
    kept = extract.nearest_release(pages(spark, table(*RELEASES)), F.lit(date(2025, 8, 21)), missing="null").first()
    assert kept["consensus"] is None and kept["surprise"] is None


def test_unreadable_number_drops_the_record(spark):
    rows = [["2025-08-20", "", "", "", "n/a", "8M", "7M"], ["2025-08-13", "", "", "", "1M", "8M", "7M"]]
    assert extract.nearest_release(pages(spark, table(*rows)), F.lit(date(2025, 8, 21))).isEmpty()


def test_latest_release_takes_future_and_short_rows(spark):
    html = "<table><tbody><tr><td>2025-08-20</td><td id='actual'>1M</td></tr><tr><td>2099-01-01</td><td id='actual'>2M</td></tr><tr><td>2100-01-01</td><td id='actual'></td></tr></tbody></table>"
    got = extract.latest_release(pages(spark, html)).first()
    assert (got["date"], got["actual"], got["consensus"], got["surprise"]) == (date(2099, 1, 1), 2.0, 0.0, 2.0)


def test_ticker(spark):
    label = "<div data-bind='text: tickingAvgLastUpdated'>2 min ago</div>"
    html = [
        "<p id='tickingAvgPriceText'>$3.15</p>" + label,
        "<html><body><p id='tickingAvgPriceText'>--</p><p>$12.5 and $3.<b>20</b></p></body></html>",
        "<html><body><p>nothing</p></body></html>",
    ]
    got = [(r["price"], r["label"]) for r in extract.ticker(pages(spark, *html)).orderBy("page_id").collect()]
    assert got == [(3.15, "2 min ago"), (3.2, "Unknown"), (None, "Unknown")]
    strict = extract.ticker(pages(spark, *html), fallback=False).orderBy("page_id").collect()
    assert [r["price"] for r in strict] == [3.15, None, None]


def test_assembled_records(spark):
    at = ntz("2025-08-25 03:00:00")
    good, bad = extract.average_observations(pages(spark, table(["Regular grade"], ["Current Avg.", "$3.152"]), table(["x" * 30, "y"])), at)
    row = good.first()
    assert (row["source"], row["fuel_type"], row["price"], row["region"]) == (DAILY_AVG, "regular", 3.152, "United States")
    assert (row["label_ts"], row["as_of_date"], row["scraped_at"]) == ("Current as of 2025-08-24", date(2025, 8, 23), datetime(2025, 8, 25, 3))
    assert [r["page_id"] for r in bad.collect()] == [1]
    good, _ = extract.quote_observations(pages(spark, '<p class="price">$2.045</p>'), RBOB, at)
    assert good.first()["price"] == 2.045 and good.first()["label_ts"] == "Unknown"
    today = F.lit(date(2025, 8, 21))
    good, _ = extract.release_observations(pages(spark, table(*RELEASES)), STOCKS, today, at, True)
    assert (good.first()["label_ts"], good.first()["surprise"]) == ("2025-08-13", -2.1)
    good, _ = extract.release_observations(pages(spark, table(*RELEASES)), RUNS, today, at, False)
    assert "consensus" not in good.columns


def test_pages_are_written_and_read_in_many_tasks(spark, sf_dir):
    """One small file of events makes pages for all cores."""
    from fuelscope.workload import extraction

    events = extraction.events(spark, sf_dir)
    assert events.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism
    filled = events.groupBy(F.spark_partition_id()).count().count()
    assert filled == 4 * spark.sparkContext.defaultParallelism


def test_whole_cells_are_read_as_their_parts():
    """A cell of mere text, in one step, equals the same cell with a comment in it."""
    page = "<table><tbody><tr><td>open<td id=\"actual\"> 7 &amp; > 8 </td><th>h<td></td></tr><tr><TD class=\"a\" id=\"b\">x\n y</TD></tr></tbody></table>"
    assert html.table_rows(page) == html.table_rows(page.replace("</td>", "<!-- --></td>").replace("</TD>", "<!-- --></TD>"))
    assert [r["cells"] for r in html.table_rows(page)] == [["open", "7 & > 8", ""], ["x y"]]
    assert [r["ids"] for r in html.table_rows(page)] == [["", "actual", ""], ["b"]]
