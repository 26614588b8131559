"""Ratios and screens on fundamentals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pe_ratio(price: Column, eps: Column) -> Column:
    return F.when(eps > 0, price / eps)


def _ratio(num: str, den: str, scale: float = 1.0) -> Column:
    """Quotient when both sides are known and neither is zero."""
    n, d = F.col(num), F.col(den)
    return F.when((n != 0) & (d != 0), n / d * scale)


def with_ratios(df: DataFrame) -> DataFrame:
    """Profitability, leverage and margin ratios; percentages where the name says nothing else."""
    return df.withColumns(
        {
            "roe": _ratio("net_profit", "equity", 100.0),
            "roa": _ratio("net_profit", "total_assets", 100.0),
            "debt_to_equity": _ratio("total_debt", "equity"),
            "current_ratio": _ratio("current_assets", "current_liabilities"),
            "operating_margin": _ratio("operating_profit", "revenue", 100.0),
            "net_margin": _ratio("net_profit", "revenue", 100.0),
        }
    )


def strong_fundamentals(rows: DataFrame, roe: float = 15.0, debt_to_equity: float = 1.0, net_margin: float = 10.0, promoter: float = 50.0) -> DataFrame:
    """Rows (with ratios and the promoters' share) above or, for debt, below the limits; unknown values do not pass."""
    return rows.filter((F.col("roe") > roe) & (F.col("debt_to_equity") < debt_to_equity) & (F.col("net_margin") > net_margin) & (F.col("promoter") > promoter))


def undervalued(rows: DataFrame, pe: float = 20.0, roe: float = 15.0, debt_to_equity: float = 1.0, promoter: float = 50.0) -> DataFrame:
    """Rows (with ratios, ``eps``, ``close`` and the promoters' share) that are sound and cheap; adds ``pe``."""
    sound = rows.filter((F.col("roe") > roe) & (F.col("debt_to_equity") < debt_to_equity) & (F.col("promoter") > promoter))
    return sound.withColumn("pe", pe_ratio(F.col("close"), F.col("eps"))).filter(F.col("pe") < pe)


def latest_period(df: DataFrame, column: str) -> DataFrame:
    """Rows of the newest period, found by a scalar subquery."""
    newest = df.agg(F.max(column)).scalar()
    return df.filter(F.col(column) == newest)
