"""The collection job: pages of all sources become tagged records in one pass; they are
screened against the stored table, held against its unique key and written at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.clock import as_of_by_lag, as_of_label
from ..functions.text import dollar_price, parse_price
from ..joins import join_same
from ..operators import extract
from ..operators.html import parts_of_page
from ..operators.lookup import screen_batch
from ..schema import DAILY_AVG, FUEL_TYPE, KEY, RBOB, REGION, RETAIL, RUNS, SCREENED, SOURCES, STOCKS, WTI
from ..session import broadcast_if_small, cut_lineage

FIELDS = ["source", "fuel_type", "price", "label_ts", "region", "consensus", "surprise", "scraped_at", "as_of_date"]
_QUOTE = [*extract.QUOTE_PRICE, *extract.QUOTE_LABEL]
SELECTORS = {RETAIL: extract.TICKER, RBOB: _QUOTE, WTI: _QUOTE}


def records(pages: DataFrame, scraped_at: Column, today: Column) -> DataFrame:
    """One record for each page of ``page_id, source, html``, parsed once, whatever its
    source. ``reason`` is ``source`` for a source that is not known, ``time`` without a
    time of reading, ``unread`` without a price, else NULL; only then is there a price.
    """
    read = pages.select(
        "page_id",
        "source",
        scraped_at.alias("scraped_at"),
        today.alias("_today"),
        parts_of_page(F.col("html"), F.col("source"), SELECTORS).alias("_page"),
    )
    texts, rows = F.col("_page.texts"), F.col("_page.rows")
    shown, shown_label = extract.ticker_texts(texts)
    quoted, quoted_label = extract.quote_texts(texts, len(extract.QUOTE_PRICE), len(extract.QUOTE_LABEL))
    entry = extract.release_entry(rows, *extract.nearest_rule(F.col("_today")))
    read = read.withColumn("_entry", F.when(F.col("source").isin(STOCKS, RUNS), entry))
    release = extract.release_values(F.col("_entry"))

    def by_source(choices: dict[str, Column]) -> Column:
        return F.coalesce(*[F.when(F.col("source") == s, c) for s, c in choices.items()])

    futures = parse_price(quoted)
    day = F.date_format(release["date"], "yyyy-MM-dd")
    average = dollar_price(extract.labelled_text(rows))
    price = by_source({RETAIL: shown, DAILY_AVG: average, RBOB: futures, WTI: futures, STOCKS: release["actual"], RUNS: release["actual"]})
    label = by_source(
        {RETAIL: shown_label, DAILY_AVG: as_of_label(F.col("scraped_at")), RBOB: quoted_label, WTI: quoted_label, STOCKS: day, RUNS: day}
    )
    reason = (
        F.when(~F.coalesce(F.col("source").isin(SOURCES), F.lit(False)), "source")
        .when(F.col("scraped_at").isNull(), "time")
        .when(price.isNull(), "unread")
    )
    found = read.select(
        "page_id",
        "source",
        by_source({s: F.lit(f) for s, f in FUEL_TYPE.items()}).alias("fuel_type"),
        price.alias("price"),
        label.alias("label_ts"),
        F.lit(REGION).alias("region"),
        by_source({STOCKS: release["consensus"]}).alias("consensus"),
        by_source({STOCKS: release["surprise"]}).alias("surprise"),
        "scraped_at",
        by_source({DAILY_AVG: as_of_by_lag(F.col("scraped_at"))}).alias("as_of_date"),
        reason.alias("reason"),
    )
    return found.withColumn("price", F.when(F.col("reason").isNull(), F.col("price")))


def collect(pages: DataFrame, stored: DataFrame, now: Column, scraped_at: Column, today: Column, tie: str | None = None) -> DataFrame:
    """Every record with ``accepted`` and ``reason``: those of ``records``, then ``last``
    or ``week`` (too far from the last stored price, or from the last one a week before
    ``now``), ``stored`` (its key is in the table) and ``copy`` (its key is that of an
    accepted page with a smaller id, or with the same id).

    All pages of a batch are judged against what was stored before it. The pages are
    parsed in the one pass that writes the records; everything later reads those, and
    the stored table is reduced to a row for each source and to the keys of the batch.
    """
    numbered = records(pages, scraped_at, today).withColumn("_row", F.monotonically_increasing_id())
    found = cut_lineage(numbered)
    unread = found.filter("reason is not null").withColumn("accepted", F.lit(False))
    price = stored.select("source", "price", "scraped_at", *([tie] if tie else []))
    judged = screen_batch(found.filter("reason is null").drop("reason"), price, now, ["source"], SCREENED, tie=tie)

    # Least page of each key, a partial aggregate; no key's pages meet in one task.
    order = F.struct("page_id", "_row")
    first = cut_lineage(judged.filter("accepted").groupBy(*KEY).agg(F.min(order)["_row"].alias("_first")))
    taken = stored.select(*KEY).join(broadcast_if_small(first.select(*KEY)), KEY, "left_semi").distinct()
    marks = first.join(taken.withColumn("_stored", F.lit(True)), KEY, "left")
    marked = join_same(judged, broadcast_if_small(marks), KEY, "left")
    why = (
        F.when(~F.col("accepted"), F.col("reason"))
        .when(F.col("_stored"), "stored")
        .when(F.col("_row") != F.col("_first"), "copy")
    )
    columns = ["page_id", *FIELDS, "accepted", "reason"]
    tagged = marked.withColumn("reason", why).withColumn("accepted", F.col("reason").isNull())
    return tagged.select(*columns).unionByName(unread.select(*columns))
