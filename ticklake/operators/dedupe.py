"""Duplicates and cross-exchange deduplication."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: list[str], name: str = "copies") -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias(name)).filter(F.col(name) > 1)


def duplicate_members(df: DataFrame, keys: list[str], name: str = "copies") -> DataFrame:
    """Every row of a duplicated key.  Counting and joining back lets one huge group of copies be
    split by the adaptive skew join, which a window over the key could not.  The struct key lets
    null keys count as equal, as grouping does."""
    keyed = df.withColumn("_key", F.struct(*keys))
    return keyed.join(duplicate_keys(keyed, ["_key"], name), "_key").drop("_key")


def prefer_first_source(first: DataFrame | None, second: DataFrame | None, key: str) -> DataFrame:
    """All rows of ``first`` and the rows of ``second`` whose key is null or absent from ``first``."""
    if first is None and second is None:
        raise ValueError("neither source has data")
    if second is None or first is None:
        return first if second is None else second
    known = first.select(key).filter(F.col(key).isNotNull()).distinct()
    return first.unionByName(second.join(known, key, "left_anti").select(*first.columns))


def first_nonempty(sources: list[DataFrame]) -> DataFrame:
    """Rows of the first source that has any, decided by the data and not by the driver."""
    ranked = [s.withColumn("_rank", F.lit(i)) for i, s in enumerate(sources)]
    rows = reduce(DataFrame.unionByName, ranked)
    best = reduce(DataFrame.unionByName, [s.select("_rank").limit(1) for s in ranked]).agg(F.min("_rank"))
    return rows.filter(F.col("_rank") == best.scalar()).drop("_rank")
