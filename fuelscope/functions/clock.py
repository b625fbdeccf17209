"""Three clocks: label text, scrape instant (UTC) and as-of date (New York)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F

from ..schema import DAILY_AVG, RETAIL

NEW_YORK = "America/New_York"

# Label spellings accepted for market data, by shape: a text that has the shape is
# parsed once, one that has none is not parsed at all.
LABEL_PATTERNS = [
    (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", "yyyy-MM-dd"),
    (r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$", "yyyy-MM-dd HH:mm:ss"),
    (r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}$", "yyyy-MM-dd HH:mm"),
    (r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4} [0-9]{1,2}:[0-9]{2}:[0-9]{2} [AP]M$", "M/d/yyyy h:mm:ss a"),
    (r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4} [0-9]{1,2}:[0-9]{2} [AP]M$", "M/d/yyyy h:mm a"),
    (r"^[A-Z][a-z]{2} [0-9]{1,2}, [0-9]{4} [0-9]{1,2}:[0-9]{2} [AP]M$", "MMM d, yyyy h:mm a"),
    (r"^[A-Z][a-z]{2} [0-9]{1,2}, [0-9]{4}$", "MMM d, yyyy"),
]


def ntz(value: datetime | str | Column) -> Column:
    """A UTC wall-clock literal (or column) as ``timestamp_ntz``."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    return F.lit(str(value)).cast("timestamp_ntz")


def to_new_york(utc: Column) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(NEW_YORK), utc)


def from_new_york(wall: Column) -> Column:
    """A wall time skipped in spring moves one hour on; one that occurs twice in
    autumn is taken as the first."""
    return F.convert_timezone(F.lit(NEW_YORK), F.lit("UTC"), wall)


def ny_date(utc: Column) -> Column:
    return F.to_date(to_new_york(utc))


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def month_end(day: Column) -> Column:
    return F.last_day(day)


def next_sunday(day: Column) -> Column:
    """The Sunday strictly after ``day``."""
    return F.next_day(day, "Sun")


def week_anchor(now_utc: Column) -> Column:
    """Monday noon, New York, of the running week; before it, a week earlier."""
    wall = to_new_york(now_utc)
    monday = F.date_sub(F.to_date(wall), F.weekday(wall)).cast("timestamp_ntz")
    noon = monday + F.expr("interval 12 hours")
    return F.when(wall < noon, noon - F.expr("interval 7 days")).otherwise(noon)


def zone_text(utc: Column) -> Column:
    """``2024-01-30 13:00 EST``; an em dash where there is no time."""
    wall = to_new_york(utc)
    zone = F.when(wall == utc - F.expr("interval 5 hours"), F.lit("EST")).otherwise(F.lit("EDT"))
    text = F.concat(F.date_format(wall, "yyyy-MM-dd HH:mm"), F.lit(" "), zone)
    return F.when(utc.isNull(), F.lit("—")).otherwise(text)


def market_open(utc: Column) -> Column:
    """Sunday 18:00 to Friday 20:00, New York."""
    wall = to_new_york(utc)
    day, hour = F.weekday(wall), F.hour(wall)
    return (
        ((day == 6) & (hour >= 18)) | (day < 4) | ((day == 4) & (hour < 20))
    )


def iso_date_in(text: Column) -> Column:
    """First ``YYYY-MM-DD`` of the text that is a date."""
    return F.try_to_date(F.nullif(F.regexp_extract(text, r"([0-9]{4}-[0-9]{2}-[0-9]{2})", 1), F.lit("")), "yyyy-MM-dd")


def label_time(text: Column) -> Column:
    """Wall time of a market label, zone suffix dropped, by explicit patterns."""
    bare = F.trim(F.regexp_replace(text, r" E[DS]?T\b", ""))
    bare = F.regexp_replace(F.regexp_replace(bare, r"(?i)\ba\.m\.", "AM"), r"(?i)\bp\.m\.", "PM")
    shaped = [F.when(bare.rlike(shape), F.try_to_timestamp(bare, F.lit(p))) for shape, p in LABEL_PATTERNS]
    return F.coalesce(*shaped).cast("timestamp_ntz")


def event_time(source: Column, label: Column, scraped_text: Column) -> Column:
    """UTC time of an imported row by the rule of its source; NULL where the text
    cannot be read (the caller decides between *now* and rejection)."""
    source = F.trim(source)
    eight = iso_date_in(label).cast("timestamp_ntz") + F.expr("interval 8 hours")
    clock = F.try_to_timestamp(F.trim(scraped_text), F.lit("M/d/yyyy h:mm:ss a")).cast("timestamp_ntz")
    midnight = F.to_date(label_time(label)).cast("timestamp_ntz")
    wall = (
        F.when(source == DAILY_AVG, eight)
        .when(source == RETAIL, clock)
        .when(source.startswith("marketwatch_"), label_time(label))
        .when(source.startswith("tradingeconomics_"), midnight)
    )
    return from_new_york(wall)


def as_of_from_label(source: Column, label: Column) -> Column:
    return F.when(F.trim(source) == DAILY_AVG, iso_date_in(label))


def as_of_by_lag(utc: Column) -> Column:
    """The daily average describes the day before it is read."""
    return F.date_sub(ny_date(utc), 1)


def as_of_label(utc: Column) -> Column:
    return F.concat(F.lit("Current as of "), F.date_format(ny_date(utc), "yyyy-MM-dd"))


def label_date(label: Column, zone: str = "UTC") -> Column:
    """Date of a weekly release. A label date is midnight in ``zone`` seen from
    New York: with UTC it falls on the day before, with New York on its own day."""
    wall = label_time(label)
    return F.to_date(F.convert_timezone(F.lit(zone), F.lit(NEW_YORK), wall))
