"""Sample tables for trials and tests, generated on the executors and equal in every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _noise(*parts: Column) -> Column:
    """A number in [0, 1) fixed by its arguments."""
    return F.pmod(F.xxhash64(*parts), F.lit(10_000)) / 10_000


def _grid(spark: SparkSession, symbols: int, steps: int) -> DataFrame:
    ids = spark.range(symbols * steps)
    return ids.select(
        F.concat(F.lit("SYM"), F.lpad((F.col("id") % symbols).cast("string"), 3, "0")).alias("symbol"), F.expr(f"CAST(id DIV {symbols} AS INT)").alias("step")
    )


def sample_bars(spark: SparkSession, symbols: int = 10, days: int = 100, start: str = "2024-01-01") -> DataFrame:
    """Daily bars on weekdays: close moves within 5 % of a base, high and low 0.5 % around it."""
    base = 100 + _noise(F.col("symbol")) * 900
    close = base * (1 + (F.col("step") % 10 - 5) / 100)
    rows = _grid(spark, symbols, days).withColumns({"trade_date": F.date_add(F.lit(start).cast("date"), F.col("step")), "close": close})
    volume = (F.lit(1000) + _noise(F.col("symbol"), F.col("step")) * 9000).cast("bigint")
    return rows.filter(F.weekday("trade_date") < 5).select(
        "symbol", "trade_date", F.col("close").alias("open"), (F.col("close") * 1.005).alias("high"), (F.col("close") * 0.995).alias("low"), "close",
        volume.alias("volume"), (F.col("close") * volume).alias("turnover"),
    )


def sample_macro(spark: SparkSession, codes: tuple[str, ...] = ("CPI_COMBINED", "WPI_ALL", "IIP_GENERAL"), months: int = 36, start: str = "2022-01-01") -> DataFrame:
    """Monthly series with a trend and a yearly season."""
    rows = spark.range(months).select(F.explode(F.array(*[F.lit(c) for c in codes])).alias("indicator_code"), F.col("id").cast("int").alias("n"))
    season = F.sin(F.col("n") * 2 * 3.141592653589793 / 12) * 2
    value = F.lit(100.0) + F.col("n") * 0.4 + season + _noise(F.col("indicator_code"), F.col("n"))
    return rows.select("indicator_code", F.add_months(F.lit(start).cast("date"), F.col("n")).alias("indicator_date"), F.round(value, 2).alias("value"))


def sample_financials(spark: SparkSession, symbols: int = 10, quarters: int = 8, start: str = "2022-03-31") -> DataFrame:
    """Quarter-end statements with the fields the ratios need."""
    rows = _grid(spark, symbols, quarters).withColumn("period_end_date", F.last_day(F.add_months(F.lit(start).cast("date"), F.col("step") * 3)))
    revenue = F.lit(1000.0) + _noise(F.col("symbol"), F.col("step")) * 500
    return rows.select(
        "symbol", "period_end_date", F.year("period_end_date").alias("year"), F.quarter("period_end_date").alias("quarter"), revenue.alias("revenue"),
        (revenue * 0.2).alias("operating_profit"), (revenue * 0.12).alias("net_profit"), F.lit(800.0).alias("equity"), F.lit(2000.0).alias("total_assets"),
        F.lit(300.0).alias("total_debt"), F.lit(600.0).alias("current_assets"), F.lit(400.0).alias("current_liabilities"), F.lit(10.0).alias("eps"),
    )


def sample_shareholding(spark: SparkSession, symbols: int = 10, quarters: int = 8, start: str = "2022-03-31") -> DataFrame:
    """Quarter-end holdings that add up to 100 %."""
    rows = _grid(spark, symbols, quarters).withColumn("quarter_end_date", F.last_day(F.add_months(F.lit(start).cast("date"), F.col("step") * 3)))
    promoter = F.round(40 + _noise(F.col("symbol"), F.col("step")) * 30, 2)
    return rows.select("symbol", "quarter_end_date", promoter.alias("promoter"), (100 - promoter).alias("public"))
