"""Numbers and labels out of scraped text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..schema import RETAIL

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def number(text: Column) -> Column:
    """Plain number, else NULL. The pattern keeps out spellings that only the JVM
    takes as numbers (``1d``, ``NaN``)."""
    t = F.trim(text.cast("string"))
    return F.when(t.rlike(_NUMBER), t.try_cast("double"))


def parse_price(text: Column) -> Column:
    """Digits and dots only; nothing left or two dots give NULL. The sign is lost."""
    return number(F.regexp_replace(text, "[^0-9.]", ""))


def dollar_price(text: Column) -> Column:
    return number(F.replace(text, F.lit("$"), F.lit("")))


def magnitude(text: Column) -> Column:
    """``-2.1M`` -> -2.1."""
    return number(F.replace(text, F.lit("M"), F.lit("")))


def consensus_value(text: Column, missing: str = "zero") -> Column:
    """Magnitude of the expectation; an empty cell is 0.0 (or NULL on request),
    a cell that is not a number is NULL either way."""
    empty = text.isNull() | (F.trim(text) == "")
    return F.when(empty, F.lit(0.0 if missing == "zero" else None).cast("double")).otherwise(
        magnitude(text)
    )


def first_plausible_price(text: Column, low: float = 1.0, high: float = 10.0) -> Column:
    """First ``$n.nn`` of the whole text strictly between the bounds."""
    found = F.transform(
        F.regexp_extract_all(text, F.lit(r"\$([0-9]+\.[0-9]+)"), F.lit(1)),
        lambda s: s.try_cast("double"),
    )
    return F.get(F.filter(found, lambda v: (v > low) & (v < high)), F.lit(0))


def clean_label(text: Column, default: Column | str = "Unknown") -> Column:
    default = F.lit(default) if isinstance(default, str) else default
    bare = F.trim(F.replace(text, F.lit("Last Updated:"), F.lit("")))
    return F.coalesce(F.nullif(bare, F.lit("")), default)


def normal_fuel_type(source: Column, fuel_type: Column) -> Column:
    fuel = F.lower(F.trim(fuel_type))
    retail = (F.trim(source) == RETAIL) & fuel.isin("regular", "regular_gas")
    return F.when(retail, F.lit("regular_gas")).otherwise(fuel)


def is_blank_name(name: Column) -> Column:
    """NULL, blank or the text ``nan`` in any case."""
    return name.isNull() | F.lower(F.trim(name)).isin("", "nan")


def money(value: Column, digits: int = 3, missing: str = "No data") -> Column:
    return F.when(value.isNull(), F.lit(missing)).otherwise(
        F.format_string(f"$%.{digits}f", value)
    )


def plain(value: Column, digits: int = 3, missing: str = "—") -> Column:
    return F.when(value.isNull(), F.lit(missing)).otherwise(F.format_string(f"%.{digits}f", value))


def percent(share: Column) -> Column:
    return F.format_string("%.1f%%", share * 100.0)
