"""Messages in envelopes: decoding by schema version, normalising, and the split by quality in one step.

An envelope is a JSON object of the fields in ``functions.envelope.ENVELOPE`` and a ``payload`` object whose shape its
``schema_version`` names.  What cannot be decoded goes to a table of its own with the reason and the message as it
came, so nothing is lost and a fixed decoder can read it again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.functions.envelope import ENVELOPE
from ticklake.quality import outcome, rules

FIELDS = "event_id string, event_time timestamp, ingest_time timestamp, source string, schema_version string, entity_id string, payload string"
REQUIRED = (*ENVELOPE, "payload")


@dataclass(frozen=True)
class Version:
    """Shape of one version's payload and how its fields become the common columns."""

    payload: str
    columns: dict[str, Callable[[Column], Column]]


def decoded(messages: DataFrame, versions: dict[str, Version], value: str = "value") -> DataFrame:
    """Envelope fields, the common columns of all ``versions``, ``reason`` (null where all is well) and ``message``.

    Every version must name the same columns, each a function of the payload.  A message is
    rejected as ``unreadable`` (no JSON object), ``incomplete`` with the names of what is missing, ``unknown version``
    or ``bad payload`` (not an object of that version's shape).
    """
    names = {tuple(sorted(v.columns)) for v in versions.values()}
    if len(names) != 1:
        raise ValueError("all versions must give the same columns")
    text = F.col(value).cast("string")
    rows = messages.select(text.alias("message"), F.from_json(text, FIELDS).alias("e"))
    # an object that cannot be read has no field at all
    missing = F.concat_ws(",", *[F.when(F.col(f"e.{f}").isNull(), F.lit(f)) for f in REQUIRED])
    rows = rows.withColumn("missing", missing).select("message", "missing", "e.*")
    for version, shape in versions.items():
        rows = rows.withColumn(f"_{version}", F.when(F.col("schema_version") == version, F.from_json("payload", f"{shape.payload}, _bad string", {"columnNameOfCorruptRecord": "_bad"})))
    known = F.coalesce(F.col("schema_version").isin(list(versions)), F.lit(False))
    bad = F.lit(False)
    for version in versions:
        p = F.col(f"_{version}")
        bad = bad | (F.coalesce(F.col("schema_version") == version, F.lit(False)) & (p.isNull() | p["_bad"].isNotNull()))
    nothing = F.col("missing") == ",".join(REQUIRED)
    reason = (
        F.when(F.col("message").isNull() | nothing, "unreadable").when(F.col("missing") != "", F.concat(F.lit("incomplete: "), "missing"))
        .when(~known, "unknown version").when(bad, "bad payload")
    )
    common = {}
    for name in sorted(next(iter(names))):
        per_version = [F.when(F.col("schema_version") == v, shape.columns[name](F.col(f"_{v}"))) for v, shape in versions.items()]
        common[name] = F.coalesce(*per_version)
    return rows.withColumn("reason", reason).select(*ENVELOPE, *[c.alias(n) for n, c in common.items()], "reason", "message")


def envelope_step(versions: dict[str, Version], normalise: Callable[[DataFrame], DataFrame], checks_of: Callable[[DataFrame], list[rules.Check]], path: str, table: str, stamp: str):
    """Micro-batch step: decode, normalise and validate; good rows, quarantined rows and rejected messages each go to
    a folder of the batch, which a repeated batch replaces.  The batch is decoded once and written with all three
    verdicts before it is split, so the three agree."""

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = decoded(batch, versions)
        staged = f"{path}/decoded/batch={batch_id}"
        rows.write.mode("overwrite").parquet(staged)
        rows = spark.read.schema(rows.schema).parquet(staged)
        rows.where("reason is not null").select("reason", "message").write.mode("overwrite").parquet(f"{path}/rejected/batch={batch_id}")
        normal = normalise(rows.where("reason is null").drop("reason", "message"))
        flagged = rules.flag(normal, checks_of(normal))
        outcome.good_rows(flagged).write.mode("overwrite").parquet(f"{path}/good/batch={batch_id}")
        outcome.quarantine_rows(flagged, table, stamp).write.mode("overwrite").parquet(f"{path}/quarantine/batch={batch_id}")

    return step
