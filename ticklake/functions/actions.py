"""Corporate-action text and factors as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Purpose patterns; the first action with a hit wins, in this order.
ACTION_PATTERNS = (
    ("SPLIT", ("split", "sub-division", "subdivision")),
    ("BONUS", ("bonus", "capitalisation")),
    ("DIVIDEND", ("dividend", "div")),
    ("RIGHTS", ("rights",)),
    ("INTEREST_PAYMENT", ("interest",)),
    ("EGMMEETING", ("egm", "agm", "meeting")),
    ("DEMERGER", ("demerger", "de-merger")),
    ("MERGER", ("merger", "amalgamation")),
    ("BUYBACK", ("buy-back", "buyback")),
)
SPLIT_PATTERN = r"rs\.?\s*(\d+(?:\.\d+)?)\s*/?\-?\s*to\s*rs\.?\s*(\d+(?:\.\d+)?)"
BONUS_PATTERN = r"(\d+)\s*(?:[:]\s*|for\s+)(\d+)"
DIVIDEND_PATTERN = r"rs\.?\s*(\d+(?:\.\d+)?)\s*/?\-?\s*per\s*share"


def action_type(purpose: Column) -> Column:
    """Kind of action named by the purpose; null for a null or empty purpose."""
    low = F.lower(purpose)
    kind = F.lit("OTHER")
    for name, words in reversed(ACTION_PATTERNS):
        kind = F.when(low.rlike("|".join(words)), name).otherwise(kind)
    return F.when(purpose != "", kind)


def _number(purpose: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(F.lower(purpose), pattern, group).try_cast("double")


def split_ratio(purpose: Column) -> Column:
    """New shares per old one from "Rs X to Rs Y": the whole part of X / Y, below 1 (a reverse split) X / Y itself."""
    ratio = F.try_divide(_number(purpose, SPLIT_PATTERN, 1), _number(purpose, SPLIT_PATTERN, 2))
    return F.when(ratio >= 1, F.floor(ratio).cast("double")).otherwise(ratio)


def split_shares(purpose: Column) -> Column:
    """Whole new shares per old one; 0 for a reverse split."""
    return split_ratio(purpose).cast("int")


def bonus_new(purpose: Column) -> Column:
    return _number(purpose, BONUS_PATTERN, 1).cast("int")


def bonus_held(purpose: Column) -> Column:
    return _number(purpose, BONUS_PATTERN, 2).cast("int")


def dividend_amount(purpose: Column) -> Column:
    return _number(purpose, DIVIDEND_PATTERN, 1)


def text_factor(kind: Column, purpose: Column) -> Column:
    """Price factor the text implies; 1 where it implies none."""
    bonus = F.try_divide(bonus_held(purpose) + bonus_new(purpose), bonus_held(purpose))
    split = split_ratio(purpose)
    return F.coalesce(F.when(kind == "SPLIT", split).when(kind == "BONUS", bonus), F.lit(1.0))


def _checked(ok: Column, value: Column, message: str, strict: bool) -> Column:
    refused = F.raise_error(F.lit(message)).cast("double") if strict else F.lit(None).cast("double")
    return F.when(ok, value).otherwise(refused)


def split_factor(old: Column, new: Column, strict: bool = True) -> Column:
    return _checked((old > 0) & (new > 0), F.try_divide(new, old), "split shares must be positive", strict)


def bonus_factor(new: Column, held: Column, strict: bool = True) -> Column:
    return _checked((new > 0) & (held > 0), F.try_divide(held + new, held), "bonus shares must be positive", strict)


def dividend_factor(dividend: Column, close: Column, strict: bool = True) -> Column:
    """1 - dividend / close on the ex-date."""
    return _checked((dividend >= 0) & (close > 0), 1.0 - F.try_divide(dividend, close), "dividend or close out of range", strict)


def event_factor(kind: Column, given: Column, old: Column, new: Column, held: Column) -> Column:
    """The given factor, unless it is about 1 and a ratio implies another one."""
    derived = F.when((kind == "SPLIT") & new.isNotNull(), split_factor(old, new)).when(
        (kind == "BONUS") & held.isNotNull(), bonus_factor(new, held)
    )
    base = F.coalesce(given, F.lit(1.0))
    return F.when(F.abs(base - 1.0) < 1e-9, F.coalesce(derived, base)).otherwise(base)


# Index names and name parts that decide the category, first match wins.
BROAD_INDICES = ("NIFTY50", "NIFTY100", "NIFTY500")


def index_category(name: Column) -> Column:
    return (
        F.when(name.isin(*BROAD_INDICES), "Broad Market")
        .when(name.rlike("BANK|IT|PHARMA"), "Sectoral")
        .when(name.rlike("MIDCAP|SMALLCAP"), "Market Cap")
    )
