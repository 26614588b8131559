"""Slowly changing dimensions and event-sourced membership."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake.operators.asof import Bucket, asof_join


def scd2_build(snapshots: DataFrame, key: str, as_of: str, attributes: list[str]) -> DataFrame:
    """Versions with valid_from / valid_to from one snapshot row per (key, day).

    A version starts where the attributes differ from the day before.  Days bound a key's rows.
    """
    w = Window.partitionBy(key).orderBy(as_of)
    digest = F.xxhash64(*[F.coalesce(F.col(a).cast("string"), F.lit("\u0000")) for a in attributes])
    changed = (
        snapshots.withColumn("_h", digest)
        .withColumn("_p", F.lag("_h").over(w))
        .filter(F.col("_p").isNull() | (F.col("_p") != F.col("_h")))
    )
    return changed.select(
        key, *attributes, F.col(as_of).alias("valid_from"), F.lead(as_of).over(w).alias("valid_to")
    ).withColumn("is_current", F.col("valid_to").isNull())


def scd2_merge(history: DataFrame, batch: DataFrame, key: str, as_of: Column, attributes: list[str]) -> DataFrame:
    """Apply changes (unique per key and ``as_of``) to a version history, in whatever order they arrive.

    A change holds from ``as_of`` to the next change the history knows, so a late one splits the version that covers its
    day, or comes before all versions; versions that then follow each other with equal attributes become one.  At
    equal times the batch replaces the version that starts there.  Gaps between versions stay gaps, unless a change
    falls into one.  A value that is only confirmed inside a version leaves no mark, so a late change into that version
    holds to its end.  Keys missing from the batch stay as they are.  Days bound a key's versions.
    """
    w = Window.partitionBy(key).orderBy("_from")
    # a version is its start and, where no other version follows at once, its end: the history is read once
    old = history.select(key, *attributes, F.col("valid_from").alias("_from"), "valid_to").withColumn("_next", F.lead("_from").over(w))
    ended = F.col("valid_to").isNotNull() & (F.col("_next").isNull() | (F.col("_next") > F.col("valid_to")))
    start = F.struct(F.col("_from").alias("at"), F.lit(1).alias("rank"))
    end = F.struct(F.col("valid_to").alias("at"), F.lit(2).alias("rank"))
    old = old.select(key, *attributes, F.explode(F.when(ended, F.array(start, end)).otherwise(F.array(start))).alias("_edge"))
    gap = F.col("_edge.rank") == 2
    old = old.select(key, *[F.when(~gap, F.col(a)).alias(a) for a in attributes], F.col("_edge.at").alias("_from"), F.col("_edge.rank").alias("_rank"))
    new = batch.select(key, *attributes, as_of.alias("_from"), F.lit(0).alias("_rank"))
    events = old.unionByName(new).withColumn("_gap", F.col("_rank") == 2)
    # of what begins at one time, the batch counts, then the history, then an end; the order serves the later windows too
    events = events.withColumn("_twin", F.lag("_from").over(Window.partitionBy(key).orderBy("_from", "_rank")))
    events = events.where("_twin is null or _twin <> _from")
    digest = F.xxhash64("_gap", *[F.coalesce(F.col(a).cast("string"), F.lit("\u0000")) for a in attributes])
    changed = events.withColumn("_h", digest).withColumn("_p", F.lag("_h").over(w)).where("_p is null or _p <> _h")
    out = changed.select(key, *attributes, F.col("_from").alias("valid_from"), F.lead("_from").over(w).alias("valid_to"), "_gap").where("not _gap").drop("_gap")
    return out.withColumn("is_current", F.col("valid_to").isNull())


def point_in_time(facts: DataFrame, versions: DataFrame, key: str, fact_date: str, take: list[str], bucket: Bucket | None = None) -> DataFrame:
    """Fact rows with the version valid on their date (valid_from <= date < valid_to).

    ``bucket`` splits keys with many facts by time.
    """
    found = asof_join(facts, versions, [key], fact_date, "valid_from", [*take, "valid_to"], bucket=bucket)
    open_then = F.col("valid_to").isNull() | (F.col(fact_date) < F.col("valid_to"))
    return found.withColumns({c: F.when(open_then, F.col(c)) for c in take}).drop("valid_to")


def membership(events: DataFrame, keys: list[str], as_of: Column, tiebreak: list[str]) -> DataFrame:
    """Members on a date: the latest event per key up to it, unless that event is a removal."""
    rest = [c for c in events.columns if c not in keys]
    last = (
        events.filter(F.col("effective_date") <= as_of)
        .groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct("effective_date", *tiebreak)).alias("_e"))
        .select(*keys, "_e.*")
    )
    return last.filter(F.col("action") != "REMOVE")
