"""Trading calendar: generation, lookup, neighbours and alignment.

A calendar has one row per day, so its size is bounded by the date range; the explicit broadcasts
below rely on that bound and on nothing else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEGMENTS = ("CM", "FO", "CD")
MAX_SEARCH_DAYS = 60


def iso_weekday(c: Column) -> Column:
    return F.weekday(c) + 1


def build_calendar(span: DataFrame, holidays: DataFrame) -> DataFrame:
    """Full-year calendar for ``span(first, last)`` and yearly ``holidays(mm, dd, holiday_name)``.

    A holiday on a weekend counts as a holiday.  ``segments`` repeats the day's state per segment.
    """
    # one row per day of the year, so at most 366 rows are broadcast
    holidays = holidays.groupBy("mm", "dd").agg(F.max("holiday_name").alias("holiday_name"))
    start = F.make_date(F.year("first"), F.lit(1), F.lit(1))
    end = F.make_date(F.year("last"), F.lit(12), F.lit(31))
    days = span.select(F.explode(F.sequence(start, end)).alias("trade_date"))
    joined = days.withColumns({"mm": F.month("trade_date"), "dd": F.day("trade_date")}).join(
        F.broadcast(holidays), ["mm", "dd"], "left"
    )
    weekend = iso_weekday(F.col("trade_date")) >= 6
    holiday = F.col("holiday_name").isNotNull()
    is_open = ~holiday & ~weekend
    return joined.select(
        "trade_date",
        is_open.alias("is_trading_day"),
        F.when(holiday, "MARKET_HOLIDAY").when(weekend, "WEEKEND").otherwise("NORMAL_TRADING").alias("day_type"),
        "holiday_name",
        iso_weekday(F.col("trade_date")).cast("int").alias("weekday"),
        F.array(*[F.struct(F.lit(s).alias("segment"), is_open.alias("is_open")) for s in SEGMENTS]).alias("segments"),
    )


def with_trading_flag(rows: DataFrame, date_col: str, calendar: DataFrame) -> DataFrame:
    """Attach ``is_trading_day``; a date the calendar does not know counts Monday to Friday."""
    flag = calendar.groupBy(F.col("trade_date").alias(date_col)).agg(F.bool_or("is_trading_day").alias("_flag"))
    out = rows.join(F.broadcast(flag), date_col, "left")
    fallback = iso_weekday(F.col(date_col)) < 6
    return out.withColumn("is_trading_day", F.coalesce("_flag", fallback)).drop("_flag")


def trading_day_shift(calendar: DataFrame, n: int) -> DataFrame:
    """For every calendar date the n-th trading day after it (before it when n is negative).

    Null when that day lies more than 60 days away.
    """
    if n == 0:
        raise ValueError("shift by at least one day")
    # days are numbered by the trading days up to them; the calendar is bounded by its date range
    upto = Window.orderBy("trade_date").rowsBetween(Window.unboundedPreceding, 0)
    ranked = calendar.select("trade_date", "is_trading_day").withColumn(
        "_k", F.sum(F.col("is_trading_day").cast("int")).over(upto)
    )
    targets = ranked.filter("is_trading_day").select(F.col("_k").alias("_t"), F.col("trade_date").alias("shifted"))
    # going back from a closed day, the last trading day is itself the first step
    own = F.when(F.col("is_trading_day"), F.col("_k")).otherwise(F.col("_k") + (0 if n > 0 else 1))
    out = ranked.withColumn("_t", own + n).join(F.broadcast(targets), "_t", "left")
    near = F.abs(F.datediff("shifted", "trade_date")) <= MAX_SEARCH_DAYS
    return out.select("trade_date", "is_trading_day", F.when(near, F.col("shifted")).alias("shifted"))


def with_trading_days(rows: DataFrame, date_col: str, calendar: DataFrame) -> DataFrame:
    """Rows with the trading flag of their day and the trading days next to it, null beyond the calendar or the search
    limit.  Only calendar days, bounded by their range, are broadcast."""
    near = calendar.select("trade_date")
    for n, name in ((1, "next_trading_day"), (-1, "previous_trading_day")):
        near = near.join(trading_day_shift(calendar, n).select("trade_date", F.col("shifted").alias(name)), "trade_date")
    flagged = with_trading_flag(rows, date_col, calendar)
    return flagged.join(F.broadcast(near.withColumnRenamed("trade_date", "_day")), F.col(date_col) == F.col("_day"), "left").drop("_day")


def alignment(rows: DataFrame, entity: str, calendar: DataFrame) -> DataFrame:
    """Per entity: rows on closed days (UNEXPECTED) and trading days without a row (MISSING).

    Missing days are found inside each entity's first and last date: its expected days come from one
    generated sequence per entity, filtered to trading days, less the days it has.
    """
    have = rows.select(entity, "trade_date").distinct()
    flagged = with_trading_flag(have, "trade_date", calendar)
    unexpected = flagged.filter(~F.col("is_trading_day")).select(entity, "trade_date", F.lit("UNEXPECTED").alias("issue"))
    span = have.groupBy(entity).agg(F.min("trade_date").alias("a"), F.max("trade_date").alias("b"))
    expected = with_trading_flag(
        span.select(entity, F.explode(F.sequence("a", "b")).alias("trade_date")), "trade_date", calendar
    ).filter("is_trading_day")
    missing = expected.join(have, [entity, "trade_date"], "left_anti").select(
        entity, "trade_date", F.lit("MISSING").alias("issue")
    )
    return unexpected.unionByName(missing)


def series_gaps(dates: DataFrame, entity: str, date_col: str, max_gap: int) -> DataFrame:
    """Consecutive dates of an entity more than ``max_gap`` missing days apart."""
    w = Window.partitionBy(entity).orderBy(date_col)
    prev = F.lag(date_col).over(w)
    missing = F.datediff(F.col(date_col), F.col("gap_start")) - 1
    return (
        dates.withColumn("gap_start", prev)
        .withColumn("missing_days", missing)
        .filter(F.col("missing_days") > max_gap)
        .select(entity, "gap_start", F.col(date_col).alias("gap_end"), "missing_days")
    )


def interval_minutes(text: str) -> float:
    """Minutes of an interval such as 5m, 1h or 30s."""
    unit = {"s": 1 / 60, "m": 1.0, "h": 60.0}
    if not text or text[-1] not in unit or not text[:-1].isdigit():
        raise ValueError(f"not an interval: {text!r}")
    return int(text[:-1]) * unit[text[-1]]
