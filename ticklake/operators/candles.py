"""Candles: daily bars rolled up to weeks and months."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INTERVALS = ("1d", "1w", "1M")


def week_from_sunday(c: Column) -> Column:
    return F.date_sub(c, F.dayofweek(c) - 1)


def week_from_monday(c: Column) -> Column:
    return F.date_trunc("week", c).cast("date")


def candles(bars: DataFrame, interval: str) -> DataFrame:
    """Open of the first day, close of the last, extremes and summed volume per period."""
    if interval not in INTERVALS:
        raise ValueError(f"interval must be one of {INTERVALS}")
    day = F.col("trade_date")
    start = {"1d": day, "1w": week_from_sunday(day), "1M": F.trunc(day, "MM")}[interval]
    return bars.groupBy("symbol", start.alias("period_start")).agg(
        F.min_by("open", "trade_date").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "trade_date").alias("close"),
        F.sum("volume").alias("volume"),
    )
