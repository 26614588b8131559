"""Instrument lists and symbol-master enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_instruments(rows: DataFrame, keys: list[str], label: str) -> DataFrame:
    """One row per instrument; the smallest label survives, so reruns agree."""
    named = rows.filter(F.col("symbol").isNotNull() & (F.col("symbol") != ""))
    return named.groupBy(*keys).agg(F.min(label).alias(label))


def enrich_instruments(rows: DataFrame, master: DataFrame, take: list[str]) -> DataFrame:
    """Attach master attributes by (symbol, isin); rows without an exact match retry by symbol alone.

    Every matching master row is kept, so one ticker may fan out to several instruments.
    """
    exact = rows.join(master.select("symbol", "isin", *take), ["symbol", "isin"])
    unmatched = rows.join(master.select("symbol", "isin").distinct(), ["symbol", "isin"], "left_anti")
    retried = unmatched.join(master.select("symbol", *take), "symbol", "left")
    cols = [*rows.columns, *take]
    return exact.select(*cols).unionByName(retried.select(*cols))
