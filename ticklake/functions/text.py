"""Cleaning of exchange text: missing tokens, safe casts, dates in several formats, feed intervals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens that stand for a missing cell.
PRICE_NULLS = ("-", "", "null", "NULL", "N/A")
MASTER_NULLS = ("-", "", "null", "NULL", "N/A", "NA")

# Date formats in the order they are tried.
PRICE_DATES = ("yyyyMMdd", "yyyy-M-d", "d-MMM-yyyy")
ACTION_DATES = ("d-MMM-yyyy", "d-M-yyyy", "yyyy-M-d", "d/M/yyyy")
HOLIDAY_DATES = ("d-MMM-yyyy", "d-MMMM-yyyy", "yyyy-M-d", "d/M/yyyy", "d-M-yyyy")
HOLIDAY_DATES_WITHOUT_YEAR = ("d-MMM", "d-MMMM", "d/M", "d-M")


def clean(c: Column, tokens=MASTER_NULLS) -> Column:
    """Trimmed text, null where it is a missing token (tokens hold no comma).

    ``find_in_set`` looks all tokens up in one call; feeds have dozens of columns, and spelled-out
    comparisons for each make the compiled row method too large to be optimised.
    """
    t = F.trim(c)
    return F.when(F.find_in_set(t, F.lit(",".join(tokens))) == 0, t)


def safe_double(c: Column, tokens=MASTER_NULLS) -> Column:
    """Number with optional thousands separators; null when it does not parse."""
    return F.replace(clean(c, tokens), F.lit(","), F.lit("")).try_cast("double")


def safe_long(c: Column, tokens=MASTER_NULLS) -> Column:
    """Whole part of a number; null when it does not parse."""
    return safe_double(c, tokens).try_cast("bigint")


def parse_date(c: Column, formats=ACTION_DATES) -> Column:
    """First format that fits, else null."""
    t = clean(c)
    return F.coalesce(*[F.try_to_date(t, f) for f in formats])


def parse_holiday(c: Column, year: Column) -> Column:
    """Holiday date; a text without a year takes ``year``."""
    dated = F.concat_ws("-", clean(c), year.cast("string"))
    return F.coalesce(
        parse_date(c, HOLIDAY_DATES), *[F.try_to_date(dated, f"{f}-yyyy") for f in HOLIDAY_DATES_WITHOUT_YEAR]
    )


def yyyymmdd(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd").cast("bigint")


def slice_date(c: Column) -> Column:
    """ISO or yyyyMMdd text as a date."""
    return parse_date(c, ("yyyy-M-d", "yyyyMMdd"))


def last_segment(c: Column) -> Column:
    """Text after the last slash."""
    return F.element_at(F.split(c, "/"), -1)
