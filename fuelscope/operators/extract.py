"""Observations out of stored pages.

A page is parsed once, in the task that reads it; everything after that works on
the arrays of the row, so extraction needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.clock import as_of_by_lag, as_of_label
from ..functions.text import (
    clean_label,
    consensus_value,
    dollar_price,
    first_plausible_price,
    magnitude,
    parse_price,
)
from ..schema import DAILY_AVG, FUEL_TYPE, REGION, RETAIL
from .html import rows_of, texts_of

# Selectors in order of priority.
QUOTE_PRICE = [
    "bg-quote.value",
    "h2.intraday__price .value",
    ".intraday__price .value",
    ".intraday__price",
    "[data-testid='price']",
    ".price",
]
QUOTE_LABEL = [
    "span.timestamp__time",
    ".intraday__timestamp",
    ".timestamp",
    "[data-testid='timestamp']",
    ".last-updated",
]
ADAPTER_PRICE = [
    "bg-quote.value",
    "h2.intraday__price .value",
    ".intraday__price .value",
    "[data-testid='price']",
    ".price",
    ".value",
    ".bgLast",
    ".lastValue",
    ".last-price",
    "span[data-field='last']",
    ".bgLast .value",
    ".last-value",
]
ADAPTER_LABEL = [
    "span.timestamp__time",
    ".intraday__timestamp",
    "[data-testid='timestamp']",
    ".last-updated",
    ".timestamp",
    ".last-update",
    "time",
]
TICKER_PRICE = "#tickingAvgPriceText"
TICKER_LABEL = "div[data-bind*='tickingAvgLastUpdated']"
TICKER = [TICKER_PRICE, TICKER_LABEL, "body"]
AVERAGE_LABEL = "Current Avg."


def explode_rows(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per table-body row: ``row_idx`` and ``cells``."""
    rest = [c for c in pages.columns if c != html]
    return pages.select(*rest, F.explode(rows_of(html)).alias("_r")).select(*rest, "_r.row_idx", "_r.cells")


def labelled_price(pages: DataFrame, label: str = AVERAGE_LABEL, html: str = "html") -> DataFrame:
    """Cell 1 of the first row of two or more cells whose cell 0 contains the label.
    A body of less than 20 characters is not a table yet."""
    rest = [c for c in pages.columns if c != html]
    rows = pages.select(*rest, rows_of(html).alias("_rows"))
    return rows.select(*rest, labelled_text(F.col("_rows"), label).alias("price_text"))


def labelled_text(rows: Column, label: str = AVERAGE_LABEL) -> Column:
    """The price text of ``labelled_price`` out of parsed rows."""
    hit = F.get(
        F.filter(rows, lambda r: (F.size(r["cells"]) >= 2) & F.get(r["cells"], F.lit(0)).contains(label)),
        F.lit(0),
    )
    body = F.array_join(F.flatten(F.transform(rows, lambda r: r["cells"])), " ")
    return F.when(F.length(F.trim(body)) >= 20, F.get(hit["cells"], F.lit(1)))


def first_text(texts: Column, start: int, end: int, need_digit: bool) -> Column:
    picked = [F.trim(F.get(texts, F.lit(i))) for i in range(start, end)]
    ok = [F.when(t.rlike("[0-9]") if need_digit else t != "", t) for t in picked]
    return F.coalesce(*ok)


def quote(
    pages: DataFrame,
    price_selectors: list[str] = QUOTE_PRICE,
    label_selectors: list[str] = QUOTE_LABEL,
    need_digit: bool = False,
    html: str = "html",
) -> DataFrame:
    """``price_text`` and ``label`` by selector priority, independently; without a
    price there is no label either, without a label it is ``Unknown``."""
    rest = [c for c in pages.columns if c != html]
    read = pages.select(*rest, texts_of(F.col(html), [*price_selectors, *label_selectors]).alias("_t"))
    price, label = quote_texts(F.col("_t"), len(price_selectors), len(label_selectors), need_digit)
    return read.select(*rest, price.alias("price_text"), label.alias("label"))


def quote_texts(texts: Column, prices: int, labels: int, need_digit: bool = False) -> tuple[Column, Column]:
    """Price text and label of ``quote`` out of the texts of its selectors."""
    price = first_text(texts, 0, prices, need_digit)
    label = clean_label(F.coalesce(first_text(texts, prices, prices + labels, False), F.lit("Unknown")), F.lit(""))
    return price, F.when(price.isNotNull(), label)


def release_entry(rows: Column, usable, actual) -> Column:
    """Row of the latest date among the usable ones, the first of equal dates; NULL
    where no row is usable."""

    def cell(r, i):
        return F.trim(F.get(r["cells"], F.lit(i)))

    def entry(r):
        text = cell(r, 0)
        day = F.when(
            text.rlike("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), F.try_to_date(text, "yyyy-M-d")
        )
        return F.struct(
            day.alias("date"),
            (-r["row_idx"]).alias("first"),
            F.size(r["cells"]).alias("width"),
            actual(r).alias("actual"),
            cell(r, 5).alias("previous"),
            cell(r, 6).alias("consensus"),
        )

    return F.array_max(
        F.filter(F.transform(rows, entry), lambda e: e["date"].isNotNull() & (e["actual"] != "") & usable(e))
    )


def release_values(entry: Column, missing: str = "zero") -> dict[str, Column]:
    """Numbers of an entry. A number that cannot be read drops the record: all are NULL."""
    actual = magnitude(entry["actual"])
    consensus = consensus_value(entry["consensus"], missing)
    empty = F.trim(F.coalesce(entry["consensus"], F.lit(""))) == ""
    read = entry.isNotNull() & actual.isNotNull() & (empty | consensus.isNotNull())
    values = {
        "date": entry["date"],
        "actual": actual,
        "previous": magnitude(entry["previous"]),
        "consensus": consensus,
        "surprise": actual - consensus,
    }
    return {name: F.when(read, value) for name, value in values.items()}


def _release(pages: DataFrame, html: str, usable, actual, missing: str) -> DataFrame:
    rest = [c for c in pages.columns if c != html]
    rows = pages.select(*rest, rows_of(html).alias("_rows"))
    best = rows.select(*rest, release_entry(F.col("_rows"), usable, actual).alias("_e"))
    values = release_values(F.col("_e"), missing)
    return best.select(*rest, *[v.alias(n) for n, v in values.items()]).filter("actual is not null")


def nearest_rule(today: Column):
    """Rows up to ``today`` with seven or more cells and a filled cell 4, for ``release_entry``."""
    return (
        lambda e: (e["width"] >= 7) & (e["date"] <= today),
        lambda r: F.trim(F.get(r["cells"], F.lit(4))),
    )


def nearest_release(pages: DataFrame, today: Column, html: str = "html", missing: str = "zero") -> DataFrame:
    """Latest row up to ``today`` with seven or more cells and a filled cell 4."""
    return _release(pages, html, *nearest_rule(today), missing)


def latest_release(pages: DataFrame, html: str = "html", missing: str = "zero") -> DataFrame:
    """Latest row with a filled cell of id ``actual``; future dates count, and so do
    short rows."""

    def actual(r):
        at = F.array_position(r["ids"], F.lit("actual"))
        return F.when(at > 0, F.trim(F.get(r["cells"], (at - 1).cast("int"))))

    return _release(pages, html, lambda e: F.lit(True), actual, missing)


def ticker(pages: DataFrame, html: str = "html", fallback: bool = True) -> DataFrame:
    """Price of the ticker element if it holds a digit, else the first plausible
    price anywhere in the page."""
    rest = [c for c in pages.columns if c != html]
    read = pages.select(*rest, texts_of(F.col(html), TICKER).alias("_t"))
    price, label = ticker_texts(F.col("_t"), fallback)
    return read.select(*rest, price.alias("price"), label.alias("label"))


def ticker_texts(texts: Column, fallback: bool = True) -> tuple[Column, Column]:
    """Price and label of ``ticker`` out of the texts of ``TICKER``."""
    shown, label, body = (F.get(texts, F.lit(i)) for i in range(3))
    if fallback:
        own = F.when(shown.rlike("[0-9]"), parse_price(shown))
        price = F.coalesce(own, first_plausible_price(body))
    else:
        price = dollar_price(shown)
    return price, F.coalesce(label, F.lit("Unknown"))


def assemble(
    found: DataFrame,
    source: str,
    price: Column,
    label: Column,
    consensus: Column | None = None,
    surprise: Column | None = None,
    scraped_at: Column | None = None,
    region: str = REGION,
) -> tuple[DataFrame, DataFrame]:
    """Observation rows and the rows that gave no price."""
    seen = found.withColumn("_price", price)
    good = seen.filter("_price is not null")
    columns = [
        F.lit(source).alias("source"),
        F.lit(FUEL_TYPE[source]).alias("fuel_type"),
        F.col("_price").alias("price"),
        label.alias("label_ts"),
        F.lit(region).alias("region"),
    ]
    if consensus is not None:
        columns.append(consensus.alias("consensus"))
    if surprise is not None:
        columns.append(surprise.alias("surprise"))
    if scraped_at is not None:
        columns.append(scraped_at.alias("scraped_at"))
        if source == DAILY_AVG:
            columns[3] = as_of_label(scraped_at).alias("label_ts")
            columns.append(as_of_by_lag(scraped_at).alias("as_of_date"))
    return good.select(*columns), seen.filter("_price is null").drop("_price")


def retail_observations(pages: DataFrame, scraped_at: Column) -> tuple[DataFrame, DataFrame]:
    return assemble(ticker(pages), RETAIL, F.col("price"), F.col("label"), scraped_at=scraped_at)


def average_observations(pages: DataFrame, scraped_at: Column) -> tuple[DataFrame, DataFrame]:
    price = dollar_price(F.col("price_text"))
    return assemble(labelled_price(pages), DAILY_AVG, price, F.lit(None), scraped_at=scraped_at)


def quote_observations(pages: DataFrame, source: str, scraped_at: Column) -> tuple[DataFrame, DataFrame]:
    return assemble(quote(pages), source, parse_price(F.col("price_text")), F.col("label"), scraped_at=scraped_at)


def release_observations(
    pages: DataFrame, source: str, today: Column, scraped_at: Column, with_consensus: bool
) -> tuple[DataFrame, DataFrame]:
    extra = {"consensus": F.col("consensus"), "surprise": F.col("surprise")} if with_consensus else {}
    label = F.date_format("date", "yyyy-MM-dd")
    return assemble(nearest_release(pages, today), source, F.col("actual"), label, scraped_at=scraped_at, **extra)
