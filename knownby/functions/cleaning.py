"""Column expressions that normalise, classify and guard values. All run inside codegen."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from knownby.sources.taxonomy import (
    FISCAL_YEAR_DAYS,
    MAX_COMMON_TICKER_LENGTH,
    NON_COMMON_FRAGMENTS,
    QUARTER_DAYS,
    SECTOR_PLACEHOLDERS,
    SIC_RULES,
)

_DECIMAL_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_INTEGER_TEXT = r"^\s*[+-]?[0-9]+\s*$"


def zfill(text: Column, width: int) -> Column:
    """Left-pad with zeros behind any sign; longer text is left whole (``lpad`` would cut it)."""
    signed = text.rlike("^[+-]")
    padded = F.when(signed, F.concat(F.substring(text, 1, 1),
                                     F.lpad(F.substr(text, F.lit(2)), width - 1, "0"))
                    ).otherwise(F.lpad(text, width, "0"))
    return F.when(F.length(text) < width, padded).otherwise(text)


def normalize_cik(value: Column) -> Column:
    """Company id of any input type as ten-character text; null becomes all zeros."""
    text = value.cast("string")
    number = F.when(text.rlike(_DECIMAL_TEXT), text).try_cast("double").try_cast("bigint")
    return F.coalesce(zfill(number.cast("string"), 10), zfill(text, 10), F.lit("0" * 10))


def is_common_stock(ticker: Column) -> Column:
    """True unless the symbol looks like a preferred, warrant or unit, is long, or is absent.

    Fragments match anywhere, so ordinary symbols that contain one are excluded as well.
    """
    fragments = "|".join(re.escape(f) for f in NON_COMMON_FRAGMENTS)
    fits = F.length(ticker).between(1, MAX_COMMON_TICKER_LENGTH)
    return F.coalesce(fits & ~F.upper(ticker).rlike(fragments), F.lit(False))


def classify_sic(code: Column, description: Column) -> Column:
    """struct(sector, industry) for an industry code, given as text or as a number."""
    text = code.cast("string")
    absent = text.isNull() | (text == "")
    number = F.when(text.rlike(_INTEGER_TEXT), F.trim(text)).try_cast("bigint")

    def outcome(sector: str, industry: Column) -> Column:
        return F.struct(F.lit(sector).alias("sector"), industry.alias("industry"))

    result = F.when(absent, outcome("Unknown", F.lit("Unknown")))
    result = result.when(number.isNull(),
                         outcome("Unknown", F.coalesce(description, F.lit("Unknown"))))
    for low, high, sector, label in SIC_RULES:
        industry = description if label is None else F.lit(label)
        result = result.when(number.between(low, high), outcome(sector, industry))
    return result.otherwise(outcome("Other", description))


def parse_day(text: Column) -> Column:
    """Leading ten characters of a date or timestamp text as a date; unreadable text gives null."""
    return F.try_to_date(F.substring(text, 1, 10), "yyyy-M-d")


def period_days(start: Column, end: Column) -> Column:
    return F.date_diff(end, start)


def is_quarter(is_instant: Column, days: Column) -> Column:
    return F.coalesce(~is_instant & days.between(*QUARTER_DAYS), F.lit(False))


def is_fiscal_year(is_instant: Column, days: Column) -> Column:
    return F.coalesce(~is_instant & days.between(*FISCAL_YEAR_DAYS), F.lit(False))


def non_zero(value: Column) -> Column:
    """Divisor guard: zero becomes null, so the quotient is null instead of an ANSI error."""
    return F.nullif(value, F.lit(0.0))


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def non_blank(text: Column) -> Column:
    return F.when(F.trim(text) != "", text)


def security_id(perma_ticker: Column, ticker: Column) -> Column:
    """Permanent id when present, else the symbol."""
    return F.coalesce(non_blank(perma_ticker), ticker)


def matches_pattern(text: Column, pattern: str) -> Column:
    """Case-insensitive regular-expression search."""
    return text.rlike(f"(?i){pattern}")


def lacks_sector(sector: Column) -> Column:
    return sector.isNull() | sector.isin(*SECTOR_PLACEHOLDERS)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
