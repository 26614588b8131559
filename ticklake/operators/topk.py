"""Top-k, latest rows and paging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """First k rows per group.  Spark limits each group per task before the shuffle, so a large
    group sends at most k rows from each task."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= k).drop("_rk")


def latest(df: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Row with the greatest ``version`` per key: an aggregate, combined map-side before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(version)).alias("_r"))
    return picked.select(*keys, "_r.*").select(*df.columns)


def page(df: DataFrame, order: list[Column], number: int, size: int, max_size: int = 1000) -> DataFrame:
    """1-based page of a total order; a page the size rules reject raises."""
    if number < 1 or not 1 <= size <= max_size:
        raise ValueError("page starts at 1 and size lies between 1 and the maximum")
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def page_after(df: DataFrame, key: str, last_seen, size: int) -> DataFrame:
    """Keyset page for deep paging: rows after ``last_seen``, so no earlier row is sorted."""
    return df.filter(F.col(key) > F.lit(last_seen)).orderBy(key).limit(size)
