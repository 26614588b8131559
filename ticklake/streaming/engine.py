"""Streams over event folders: reading, running to completion, and batch steps.

The file source stands in for a message topic; rows have the same shape either way.  Every sink
writes below the shared folder with its own checkpoint, so a restarted query continues and does not
repeat output.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

TICK_SCHEMA = "event_id bigint, ts timestamp, entity string, kind string, price double, props string"


def read_stream(spark: SparkSession, path: str, schema: T.StructType | str, name: str = "*.parquet", files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream; ``files_per_trigger`` bounds one micro-batch."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", name)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def ticks_from_events(events: DataFrame) -> DataFrame:
    """Event rows as ticks with a real timestamp (a watermark needs one)."""
    return events.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), F.concat(F.lit("U"), "user_id").alias("entity"),
        F.col("event_type").alias("kind"), F.col("value").alias("price"), "props",
    )


def from_topic(messages: DataFrame, payload: str) -> DataFrame:
    """Key/value messages as rows: the JSON value parsed with a declared schema."""
    return messages.select(F.col("key").cast("string").alias("entity_id"), F.from_json(F.col("value").cast("string"), payload).alias("payload")).select(
        "entity_id", "payload.*"
    )


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for queries started inside; a started query keeps its own copy."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def run_to_folder(df: DataFrame, base: str, mode: str = "append", keyed_state: bool = False, policy: str | None = None) -> StreamingQuery:
    """Process what is available into Parquet below ``base`` and stop.

    ``keyed_state`` runs on the RocksDB state store, which operators with state of their own need, and without batches
    that have no rows: state that expires by the clock would ask for one after the other and the run would not end.
    ``policy`` names the one of several watermarks that moves the query on, ``min`` or ``max``.
    """
    writer = (
        df.writeStream.format("parquet").outputMode(mode).option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
    )
    with contextlib.ExitStack() as held:
        if keyed_state:
            held.enter_context(setting(df.sparkSession, "spark.sql.streaming.stateStore.providerClass", ROCKSDB))
            held.enter_context(setting(df.sparkSession, "spark.sql.streaming.noDataMicroBatches.enabled", "false"))
        if policy:
            held.enter_context(setting(df.sparkSession, "spark.sql.streaming.multipleWatermarkPolicy", policy))
        query = writer.start()
    return _finished(query)


def _finished(query: StreamingQuery) -> StreamingQuery:
    """Wait for the end, noting the rejected rows of every micro-batch as it is reported."""
    query.late = {}
    while True:
        active = query.isActive
        for p in query.recentProgress:
            query.late[p["batchId"]] = sum(op["numRowsDroppedByWatermark"] for op in p["stateOperators"])
        if not active:
            query.awaitTermination()  # raises what ended the query
            return query
        query.awaitTermination(1)


def run_batches(df: DataFrame, base: str, step: Callable[[DataFrame, int], None], mode: str = "append") -> StreamingQuery:
    """Hand each micro-batch to ``step`` and stop when nothing is left."""
    query = df.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/checkpoint").foreachBatch(step).trigger(availableNow=True).start()
    return _finished(query)


def output(spark: SparkSession, base: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(f"{base}/out")


def late_rows(query: StreamingQuery) -> int:
    """Rows the watermark rejected, over all micro-batches of a run.

    A query keeps its last 100 reports only; they are read every second.  A gap in the batch numbers means that
    some went by unread, and is an error.
    """
    batches = sorted(query.late)
    if batches and batches != list(range(batches[0], batches[-1] + 1)):
        raise RuntimeError("some micro-batches went by unread")
    return sum(query.late.values())
