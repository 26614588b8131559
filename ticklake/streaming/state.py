"""Keyed state of streams: means in the state store, newest rows in buckets of files, ids seen by day.

By what a batch must touch:  ``momentum`` keeps a few numbers an entity in Spark's state store, so a batch
costs what its own entities cost and idle ones expire.  ``Buckets`` keeps whole rows in Parquet buckets by key hash; a
batch rewrites the buckets its keys fall into, and a commit names the version of every bucket.
``seen_step`` appends the ids of a batch below their day and reads only the days the batch has rows of.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ticklake.operators.topk import latest
from ticklake.session import path_exists

MOMENTUM_STATE = "last_us bigint, last_id bigint, last_price double, ema double, gain double, loss double"
MOMENTUM_ROWS = "event_id bigint, entity string, us bigint, price double, ema double, gain double, loss double, rsi double, late boolean"


def _mean(values: list[float | None], seed: float | None, span: int) -> list[float]:
    """Exponential means that go on from ``seed``; a row without value shows the mean so far, nan before the first."""
    alpha, mean, out = 2.0 / (span + 1), seed, []
    for x in values:
        if x is not None:
            mean = x if mean is None else (1.0 - alpha) * mean + alpha * x
        out.append(math.nan if mean is None else mean)
    return out


def _number(x: float | None) -> float | None:
    return None if x is None or math.isnan(x) else float(x)


class Momentum(StatefulProcessor):
    """Exponential means and relative strength of one entity, continued from batch to batch."""

    def __init__(self, span: int, n: int, ttl_ms: int | None) -> None:
        self.span, self.n, self.ttl_ms = span, n, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("momentum", MOMENTUM_STATE, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803  names of the interface
        known = self.state.get() if self.state.exists() else (None,) * 6
        last_us, last_id, last_price, ema, gain, loss = known
        # most entities have a few rows a batch: plain lists cost a fraction of the table operations they replace
        ordered = sorted((r for part in rows for r in zip(part["us"].tolist(), part["event_id"].tolist(), part["price"].tolist(), strict=True)), key=lambda r: r[:2])
        late = [] if last_us is None else [r for r in ordered if r[:2] <= (last_us, last_id)]
        fresh = ordered[len(late) :]
        if fresh:
            prices, changes, held = [_number(r[2]) for r in fresh], [], last_price
            for price in prices:
                # the very first price has neither gain nor loss; a row without price moves no mean
                changes.append(None if price is None else 0.0 if held is None else price - held)
                held = held if price is None else price
            emas = _mean(prices, ema, self.span)
            gains = _mean([None if d is None else max(d, 0.0) for d in changes], gain, self.n)
            losses = _mean([None if d is None else max(-d, 0.0) for d in changes], loss, self.n)
            rsis = [100.0 - 100.0 / (1.0 + g / x) if x > 0 else math.nan for g, x in zip(gains, losses, strict=True)]
            self.state.update((int(fresh[-1][0]), int(fresh[-1][1]), held, *(_number(c[-1]) for c in (emas, gains, losses))))
        else:
            emas = gains = losses = rsis = []
        none, both = [math.nan] * len(late), fresh + late
        yield pd.DataFrame(
            {
                "event_id": [r[1] for r in both], "entity": key[0], "us": [r[0] for r in both], "price": [math.nan if r[2] is None else float(r[2]) for r in both],
                "ema": emas + none, "gain": gains + none, "loss": losses + none, "rsi": rsis + none, "late": [False] * len(fresh) + [True] * len(late),
            }
        )

    def close(self) -> None:
        pass


def momentum(ticks: DataFrame, span: int = 12, n: int = 14, ttl_ms: int | None = None) -> DataFrame:
    """A stream of ticks with means and relative strength per entity; run it with ``keyed_state=True``.

    State is the last row and the means of an entity, in the state store: a batch reads and writes the entities it has
    rows of, and with ``ttl_ms`` an entity without rows for that long is forgotten.  Rows are ordered by (``ts``,
    ``event_id``); those that do not come after their entity's last row are marked ``late`` and move nothing.  The
    rows of one entity in one batch are worked on together, so the reader's rate limit bounds them.
    """
    rows = ticks.select("event_id", "entity", F.unix_micros("ts").alias("us"), "price")
    found = rows.groupBy("entity").transformWithStateInPandas(
        statefulProcessor=Momentum(span, n, ttl_ms), outputStructType=MOMENTUM_ROWS, outputMode="Append", timeMode="ProcessingTime" if ttl_ms else "None"
    )
    means = [F.when(~F.isnan(c), F.col(c)).alias(c) for c in ("price", "ema", "gain", "loss", "rsi")]
    return found.select("event_id", "entity", F.timestamp_micros("us").alias("ts"), *means, "late")


# --- newest row per key, in buckets


def _folder(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _committed(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches whose commit is complete."""
    where, fs = _folder(spark, f"{path}/commits")
    if not fs.exists(where):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(where)]
    numbers = [int(n.removeprefix("batch=")) for n in names if n.startswith("batch=")]
    return sorted(n for n in numbers if path_exists(spark, f"{path}/commits/batch={n}/_SUCCESS"))


def _versions(spark: SparkSession, path: str, batch_id: int) -> dict[int, int]:
    """Bucket -> version as that batch committed it."""
    return {r["bucket"]: r["version"] for r in spark.read.schema("bucket int, version bigint").parquet(f"{path}/commits/batch={batch_id}").collect()}


def _buckets(spark: SparkSession, path: str, versions: dict[int, int], schema: str) -> DataFrame:
    folders = [f"{path}/data/version={v}/bucket={b}" for b, v in sorted(versions.items())]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


class Buckets:
    """Rows of ``schema`` in ``buckets`` folders by the hash of ``keys``, one version a bucket and batch that touched it.

    A batch reads and rewrites only the buckets its keys fall into; all others stay where earlier batches wrote them.
    The commit, written last, names the version of every bucket, so readers see all of a batch or nothing of it, and
    a repeated batch starts from the commit before it.  Versions that none of the last ``keep`` commits names are
    deleted.  ``buckets`` must not change over the life of the state.
    """

    def __init__(self, path: str, keys: list[str], schema: str, buckets: int = 64, keep: int = 2) -> None:
        if keep < 2:
            raise ValueError("a repeated batch needs the commit before it: keep must be at least 2")
        self.path, self.keys, self.schema, self.buckets, self.keep = path, keys, schema, buckets, keep

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> set[int]:
        """Buckets that the keys of ``rows`` fall into, ``buckets`` numbers at most."""
        return {r["bucket"] for r in rows.select(self.bucket().alias("bucket")).distinct().collect()}

    def before(self, spark: SparkSession, batch_id: int, touched: set[int]) -> DataFrame:
        """Rows of those buckets as the commit before the batch has them."""
        versions = self._before(spark, batch_id)
        return _buckets(spark, self.path, {b: v for b, v in versions.items() if b in touched}, self.schema)

    def commit(self, spark: SparkSession, batch_id: int, rows: DataFrame | None, touched: set[int]) -> None:
        """Make ``rows`` the whole content of the touched buckets."""
        before = self._before(spark, batch_id)
        if touched:
            placed = rows.withColumn("bucket", self.bucket()).hint("rebalance", "bucket")
            placed.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/version={batch_id}")
        after = sorted((before | dict.fromkeys(touched, batch_id)).items())
        spark.createDataFrame(after, "bucket int, version bigint").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/batch={batch_id}")
        _expire(spark, self.path, [*[n for n in _committed(spark, self.path) if n < batch_id], batch_id], self.keep)

    def rows(self, spark: SparkSession) -> DataFrame:
        """All rows as the last complete commit has them."""
        done = _committed(spark, self.path)
        return _buckets(spark, self.path, _versions(spark, self.path, done[-1]) if done else {}, self.schema)

    def _before(self, spark: SparkSession, batch_id: int) -> dict[int, int]:
        done = [n for n in _committed(spark, self.path) if n < batch_id]
        return _versions(spark, self.path, done[-1]) if done else {}


def _expire(spark: SparkSession, path: str, done: list[int], keep: int) -> None:
    """Delete what none of the last ``keep`` commits names."""
    named = {(b, v) for n in done[-keep:] for b, v in _versions(spark, path, n).items()}
    for n in done[:-keep]:
        where, fs = _folder(spark, f"{path}/commits/batch={n}")
        fs.delete(where, True)
    where, fs = _folder(spark, f"{path}/data")
    for version in fs.listStatus(where) if fs.exists(where) else []:
        number = int(version.getPath().getName().removeprefix("version="))
        if number > done[-1]:
            continue
        if not any(v == number for _, v in named):
            fs.delete(version.getPath(), True)
            continue
        for s in fs.listStatus(version.getPath()):
            name = s.getPath().getName()
            if name.startswith("bucket=") and (int(name.removeprefix("bucket=")), number) not in named:
                fs.delete(s.getPath(), True)


def latest_step(keys: list[str], version: str, state: Buckets):
    """Micro-batch step that keeps the newest row per key in ``state``."""

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        touched = state.touched(batch)
        known = state.before(spark, batch_id, touched)
        state.commit(spark, batch_id, latest(known.unionByName(batch.select(*known.columns)), keys, version), touched)

    return step


# --- ids seen so far

SEEN = "event_id bigint, day date, batch bigint"


def seen_step(path: str, as_of: str, ttl_days: int = 30):
    """Micro-batch step that reports events, repeated ids and freshness of the batch as one row.

    An id counts as repeated where it occurs twice in the batch or an earlier batch had it.  Ids are stored below the
    day of their event, the batch's own in a folder of their own, so a batch reads the days it has rows of, writes
    its new ids only, and a repeated batch replaces what it wrote.  Days more than ``ttl_days`` before the newest one
    are deleted: an id is known for that long.  Events without time count, but are not remembered.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        day = F.to_date("ts")
        # at most a day of the calendar each
        days = [r["day"] for r in batch.select(day.alias("day")).distinct().collect() if r["day"] is not None]
        own = batch.groupBy("event_id", day.alias("day")).agg(F.count("*").alias("n"), F.max("ts").alias("ts"))
        known = spark.createDataFrame([], SEEN)
        if days and path_exists(spark, f"{path}/seen"):
            known = spark.read.schema(SEEN).parquet(f"{path}/seen").where(F.col("day").isin(days) & (F.col("batch") < batch_id))
        known = known.select(F.col("event_id").alias("_id"), F.col("day").alias("_day"), F.lit(True).alias("_seen"))
        both = own.join(known, F.col("event_id").eqNullSafe(F.col("_id")) & (F.col("day") == F.col("_day")), "left")
        fresh = both.where("_seen is null and day is not null").select("event_id", "day", F.lit(batch_id).cast("long").alias("batch"))
        fresh.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(f"{path}/seen")
        hours = (F.unix_seconds(F.lit(as_of).cast("timestamp")) - F.unix_seconds(F.max("ts"))) / 3600
        before = F.col("_seen").isNotNull()
        row = both.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("events"), F.count_if(before | (F.col("n") > 1)).alias("duplicated_ids"),
            F.coalesce(F.sum(F.col("n") - F.when(before, 0).otherwise(1)), F.lit(0)).alias("repeats"), hours.alias("freshness_hours"),
        )
        row.write.mode("overwrite").parquet(f"{path}/reports/batch={batch_id}")
        _forget(spark, f"{path}/seen", ttl_days)

    return step


def _forget(spark: SparkSession, path: str, ttl_days: int) -> None:
    """Delete the day folders more than ``ttl_days`` before the newest."""
    import datetime as dt

    where, fs = _folder(spark, path)
    found = {}
    for s in fs.listStatus(where) if fs.exists(where) else []:
        name = s.getPath().getName()
        if name.startswith("day="):
            found[dt.date.fromisoformat(name.removeprefix("day="))] = s.getPath()
    for day, folder in found.items():
        if (max(found) - day).days > ttl_days:
            fs.delete(folder, True)


# --- lateness by topic

MARKS = "topic string, newest timestamp"


def lateness_step(topic: str, ts: str, allowed_seconds: dict[str, int], path: str, default_seconds: int = 0):
    """Micro-batch step that sets rows aside which come later than their topic allows.

    A topic's mark is its newest time in earlier batches; a row is late where it lies more than the allowed seconds
    before it.  Late rows go to ``late``, all others to ``kept``, each batch in a folder of its own, and the marks
    (one row a topic) follow, so a repeated batch decides as it did before.  Rows without time are late where their
    topic has a mark.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        marks = _marks_before(spark, f"{path}/marks", batch_id)
        seconds = F.coalesce(*[F.when(F.col("topic") == t, F.lit(s)) for t, s in allowed_seconds.items()], F.lit(default_seconds))
        limits = marks.select(F.col("topic").alias("_topic"), F.timestamp_micros(F.unix_micros("newest") - seconds.cast("long") * 1_000_000).alias("_limit"))
        placed = batch.join(limits, F.col(topic).eqNullSafe(F.col("_topic")), "left")
        late = F.col("_limit").isNotNull() & F.coalesce(F.col(ts) < F.col("_limit"), F.lit(True))
        placed.where(late).select(*batch.columns).write.mode("overwrite").parquet(f"{path}/late/batch={batch_id}")
        placed.where(~late).select(*batch.columns).write.mode("overwrite").parquet(f"{path}/kept/batch={batch_id}")
        newest = batch.select(F.col(topic).alias("topic"), F.col(ts).cast("timestamp").alias("newest")).unionByName(marks).groupBy("topic").agg(F.max("newest").alias("newest"))
        newest.coalesce(1).write.mode("overwrite").parquet(f"{path}/marks/batch={batch_id}")

    return step


def _marks_before(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    where, fs = _folder(spark, path)
    numbers = [int(s.getPath().getName().removeprefix("batch=")) for s in fs.listStatus(where)] if fs.exists(where) else []
    done = [n for n in numbers if n < batch_id and path_exists(spark, f"{path}/batch={n}/_SUCCESS")]
    return spark.read.schema(MARKS).parquet(f"{path}/batch={max(done)}") if done else spark.createDataFrame([], MARKS)


def by_topic(stream: DataFrame, topic: str, ts: str, delays: dict[str, str]) -> DataFrame:
    """One stream in which every topic has a watermark of its own; ``spark.sql.streaming.multipleWatermarkPolicy`` says
    whether the slowest topic (``min``) or the fastest (``max``) moves the query on.  Other topics are left out."""
    parts = [stream.where(F.col(topic) == name).withWatermark(ts, delay) for name, delay in delays.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
