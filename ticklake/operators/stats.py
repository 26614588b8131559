"""Group statistics compared with rows, and drift between periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake.session import fresh_path


def outliers(df: DataFrame, keys: list[str], value: str, threshold: float) -> DataFrame:
    """Rows whose population z-score within their group exceeds ``threshold``.

    Group moments are aggregated map-side and joined back, so a large group is never one window.
    """
    stats = df.groupBy(*keys).agg(F.avg(value).alias("_a"), F.stddev_pop(value).alias("_s")).filter("_s > 0")
    z = (F.col(value) - F.col("_a")) / F.col("_s")
    return df.join(stats, keys).withColumn("z_score", z).filter(F.abs("z_score") > threshold).drop("_a", "_s")


def profile(df: DataFrame, keys: list[str], value: str, accuracy: int = 10000) -> DataFrame:
    """Count, mean, deviation, quartiles and null rate per group, all partially aggregated."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.avg(value).alias("mean"),
        F.stddev(value).alias("std"),
        F.percentile_approx(value, [0.25, 0.5, 0.75], accuracy).alias("q"),
        (F.count_if(F.col(value).isNull()) / F.count("*")).alias("null_rate"),
    )


def drift(current: DataFrame, baseline: DataFrame, keys: list[str], limit: float) -> DataFrame:
    """Profiles side by side; drifted when the mean moves more than ``limit`` baseline deviations."""
    base = baseline.select(*keys, F.col("mean").alias("base_mean"), F.col("std").alias("base_std"), F.col("null_rate").alias("base_null_rate"))
    shift: Column = F.try_divide(F.abs(F.col("mean") - F.col("base_mean")), F.col("base_std"))
    return current.join(base, keys).withColumn("shift", shift).withColumn("drifted", F.coalesce(F.col("shift") > limit, F.lit(False)))


def with_share(df: DataFrame, value: str, name: str) -> DataFrame:
    """Percent of the total of ``value`` in each row; the total is one value, found by a map-side combined sum."""
    return df.withColumn(name, F.try_divide(F.col(value) * 100.0, df.agg(F.sum(value)).scalar()))


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probabilities: list[float]) -> DataFrame:
    """``keys`` and ``quantiles``, an array beside ``probabilities``: exact, linear between the two nearest ranks.

    Rows become counts of (group, value) before they are shuffled.  The counts are sorted over all partitions by (group,
    value); a value's first rank is the sum of its group's counts in the partitions before and in its own up to it,
    so a group with most of the rows is sorted by many tasks and never held by one.  All quantiles are read off the
    same ranks.  Null values do not count; a group without values has nulls.
    """
    counts = df.groupBy(F.struct(*keys).alias("_key"), F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_c"))
    placed = counts.orderBy("_key", "_v").withColumn("_at", F.monotonically_increasing_id())
    path = fresh_path(df.sparkSession, "ranked")
    placed.write.parquet(path)  # the order is settled here, whatever is computed again below
    placed = df.sparkSession.read.schema(placed.schema).parquet(path).withColumn("_part", F.shiftright("_at", 33)).drop("_at")
    solid = placed.where("_v is not null")
    # a row for each partition and the groups in it
    sums = solid.groupBy("_key", "_part").agg(F.sum("_c").alias("_s"))
    group = Window.partitionBy("_key")
    earlier = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_key", "_part", F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_before"), F.sum("_s").over(group).alias("_n"))
    inside = Window.partitionBy("_key", "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("_before") + F.coalesce(F.sum("_c").over(inside), F.lit(0))
    ranked = solid.join(sums, ["_key", "_part"]).withColumn("_first", first)

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_first") <= rank) & (rank < F.col("_first") + F.col("_c")), F.col("_v")))

    ends = []
    for p in probabilities:
        place = (F.col("_n") - 1) * F.lit(float(p))
        ends += [at(F.floor(place)), at(F.ceil(place))]
    found = ranked.groupBy("_key").agg(F.first("_n").alias("_n"), *[e.alias(f"_e{k}") for k, e in enumerate(ends)])
    between = []
    for k, p in enumerate(probabilities):
        place = (F.col("_n") - 1) * F.lit(float(p))
        low, high = F.col(f"_e{2 * k}"), F.col(f"_e{2 * k + 1}")
        between.append(low + (high - low) * (place - F.floor(place)))
    found = found.select("_key", F.array(*between).alias("quantiles"))
    every = placed.select("_key").distinct()
    nothing = F.array(*[F.lit(None).cast("double") for _ in probabilities])
    return every.join(found, "_key", "left").select("_key.*", F.coalesce("quantiles", nothing).alias("quantiles"))


def exact_median(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Median per group, null for a group without values."""
    return exact_quantiles(df, keys, value, [0.5]).select(*keys, F.col("quantiles")[0].alias("median"))
