"""Streaming operators; each works on the same columns as its batch twin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.operators.asof import time_bucket
from ticklake.operators.series import ema_long, lag_long
from ticklake.quality import outcome, rules
from ticklake.streaming.state import Buckets


def dedupe(df: DataFrame, key: str, ts: str, delay: str) -> DataFrame:
    """First arrival per event id; ids are remembered for ``delay`` of event time."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def _candle_columns(order: list[str]) -> list[Column]:
    at = F.struct(*order)
    return [
        F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", at).alias("close"), F.count("*").alias("n"),
    ]


def tumbling_candles(df: DataFrame, ts: str, width: str, delay: str | None, by: list[str], slide: str | None = None) -> DataFrame:
    """Candles per window, emitted once when the watermark passes the window; without ``delay`` the stream has its own."""
    w = F.window(ts, width, slide) if slide else F.window(ts, width)
    out = (df.withWatermark(ts, delay) if delay else df).groupBy(w.alias("w"), *by).agg(*_candle_columns([ts, "event_id"]))
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "open", "high", "low", "close", "n")


def sliding_counts(df: DataFrame, ts: str, width: str, slide: str, delay: str, by: list[str]) -> DataFrame:
    out = df.withWatermark(ts, delay).groupBy(F.window(ts, width, slide).alias("w"), *by).agg(F.count("*").alias("n"), F.sum("price").alias("total"))
    return out.select(F.col("w.start").alias("window_start"), *by, "n", "total")


def sessions(df: DataFrame, ts: str, gap: str, delay: str, by: list[str]) -> DataFrame:
    """Runs of activity separated by ``gap``.

    Sessions are merged inside each input partition before the shuffle, so a busy key sends sessions
    and not rows, where the session has ``sessionWindow.merge.sessions.in.local.partition`` on, as
    ``build_session`` sets it.
    """
    out = df.withWatermark(ts, delay).groupBy(F.session_window(ts, gap).alias("w"), *by).agg(F.count("*").alias("n"))
    return out.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *by, "n")


def interval_join(left: DataFrame, right: DataFrame, key: str, within_seconds: int, delay: str) -> DataFrame:
    """Right rows at most ``within_seconds`` after a left row of the same key; both sides' state expires.

    Rows meet on (key, time slot): a left row lives in its own slot, a right row is offered to its own
    and the one before, so each pair meets once and a busy key spreads over its slots.
    """

    def slot(ts: str) -> Column:
        return F.floor(F.unix_seconds(F.col(ts)) / within_seconds)

    a = left.withWatermark("l_ts", delay).withColumn("l_slot", slot("l_ts"))
    b = right.withWatermark("r_ts", delay).withColumn("r_slot", F.explode(F.array(slot("r_ts"), slot("r_ts") - 1)))
    near = (F.col("r_ts") >= F.col("l_ts")) & (F.col("r_ts") <= F.col("l_ts") + F.expr(f"INTERVAL {within_seconds} SECONDS"))
    same = (F.col(f"l_{key}") == F.col(f"r_{key}")) & (F.col("l_slot") == F.col("r_slot"))
    return a.join(b, same & near).drop("l_slot", "r_slot")


def split_step(checks_of, good_path: str, bad_path: str, table: str, stamp: str):
    """Micro-batch step: good rows to one folder, quarantined rows to another, by batch number.

    A repeated batch replaces its own folders, so output is exactly once.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        flagged = rules.flag(batch, checks_of(batch))
        outcome.good_rows(flagged).write.mode("overwrite").parquet(f"{good_path}/batch={batch_id}")
        outcome.quarantine_rows(flagged, table, stamp).write.mode("overwrite").parquet(f"{bad_path}/batch={batch_id}")

    return step


MOMENTUM_STATE = "entity string, last_ts timestamp, last_id bigint, last_price double, ema double, gain double, loss double"


def momentum_step(out_path: str, state_path: str, late_path: str, span: int = 12, n: int = 14, unit: str = "hour", buckets: int = 64):
    """Micro-batch step for exponential means and relative strength where one entity may have most rows of a batch.

    ``state.momentum`` does the same in the state store and works on an entity's rows of a batch together; here the
    recursion inside the batch is the block-wise one, numbered by ``unit`` of time, so such an entity is not one task.
    State is the last price and means per entity, in buckets of which a batch rewrites those it touches.  A batch
    continues from the commit before it.  Rows are ordered by (``ts``, ``event_id``); those that do not come after an
    entity's last row go to ``late_path``.
    """
    state = Buckets(state_path, ["entity"], MOMENTUM_STATE, buckets)

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        hit = state.touched(batch)
        known = state.before(spark, batch_id, hit)
        both = batch.join(known, "entity", "left")
        after = F.col("last_ts").isNull() | (F.col("ts") > F.col("last_ts")) | ((F.col("ts") == F.col("last_ts")) & (F.col("event_id") > F.col("last_id")))
        both.filter(~F.coalesce(after, F.lit(False))).select(*batch.columns).write.mode("overwrite").parquet(f"{late_path}/batch={batch_id}")
        fresh = both.filter(after)
        order, by = ["ts", "event_id"], ["entity"]
        bucket = time_bucket(unit)(F.col("ts"))
        moved = lag_long(fresh, by, order, bucket, "price", "_prev")
        diff = F.col("price") - F.coalesce("_prev", "last_price")
        # an entity's very first row has neither gain nor loss
        moved = moved.withColumns({"_g": F.greatest(F.coalesce(diff, F.lit(0.0)), F.lit(0.0)), "_l": F.greatest(F.coalesce(-diff, F.lit(0.0)), F.lit(0.0))})
        means = ema_long(
            moved, {"new_ema": ("price", span), "new_gain": ("_g", n), "new_loss": ("_l", n)}, by, order, bucket,
            seeds={"new_ema": "ema", "new_gain": "gain", "new_loss": "loss"},
        )
        rows = means.select(
            "event_id", "entity", "ts", "price", F.col("new_ema").alias("ema"), F.col("new_gain").alias("gain"), F.col("new_loss").alias("loss"),
            F.when(F.col("new_loss") > 0, 100.0 - 100.0 / (1.0 + F.col("new_gain") / F.col("new_loss"))).alias("rsi"),
        )
        rows.write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")
        done = spark.read.parquet(f"{out_path}/batch={batch_id}")
        newest = done.groupBy("entity").agg(F.max_by(F.struct("ts", "event_id", "price", "ema", "gain", "loss"), F.struct("ts", "event_id")).alias("s"))
        touched = newest.select("entity", F.col("s.ts").alias("last_ts"), F.col("s.event_id").alias("last_id"), F.col("s.price").alias("last_price"), "s.ema", "s.gain", "s.loss")
        kept = known.join(touched.select("entity"), "entity", "left_anti")
        state.commit(spark, batch_id, kept.unionByName(touched), hit)

    return step


def reconcile(batch: DataFrame, stream: DataFrame, value: str) -> DataFrame:
    """Rows only one side has, and the drift of mean and null rate between them, in one row."""
    cols = batch.columns
    only_batch = batch.exceptAll(stream.select(*cols)).agg(F.count("*")).scalar()
    only_stream = stream.select(*cols).exceptAll(batch).agg(F.count("*")).scalar()
    b = batch.agg(F.avg(value)).scalar()
    nulls = F.count_if(F.col(value).isNull()) / F.count("*")
    base_nulls = batch.agg(nulls).scalar()
    return stream.agg(F.count("*").alias("n"), (F.avg(value) - b).alias("mean_drift"), (nulls - base_nulls).alias("null_rate_drift")).select(
        "n", only_batch.alias("only_batch"), only_stream.alias("only_stream"), "mean_drift", "null_rate_drift"
    )
