"""Event envelope: deterministic ids, event and ingest time, nesting and flattening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ENVELOPE = ("event_id", "event_time", "ingest_time", "source", "schema_version", "entity_id")

# Fixed value: the DNS namespace of RFC 4122.
DNS_NAMESPACE = "6ba7b8109dad11d180b400c04fd430c8"


def uuid5(name: Column) -> Column:
    """Name-based UUID in the DNS namespace, computed on the JVM side."""
    h = F.sha1(F.concat(F.unhex(F.lit(DNS_NAMESPACE)), F.encode(name, "UTF-8")))
    variant = F.translate(F.substr(h, F.lit(17), F.lit(1)), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substr(h, F.lit(1), F.lit(8)), F.lit("-"), F.substr(h, F.lit(9), F.lit(4)), F.lit("-5"),
        F.substr(h, F.lit(14), F.lit(3)), F.lit("-"), variant, F.substr(h, F.lit(18), F.lit(3)), F.lit("-"),
        F.substr(h, F.lit(21), F.lit(12)),
    )


def with_envelope(
    df: DataFrame, source: str, version: str, name: Column, entity: Column, event_date: Column, ingest_time: str
) -> DataFrame:
    """Prepend the envelope.  ``ingest_time`` is a job parameter, so reruns give the same rows."""
    return df.select(
        uuid5(name).alias("event_id"),
        event_date.cast("timestamp").alias("event_time"),
        F.lit(ingest_time).cast("timestamp").alias("ingest_time"),
        F.lit(source).alias("source"),
        F.lit(version).alias("schema_version"),
        entity.alias("entity_id"),
        *df.columns,
    )


def nest(df: DataFrame) -> DataFrame:
    """Envelope plus one ``payload`` struct."""
    payload = [c for c in df.columns if c not in ENVELOPE]
    return df.select(*[c for c in df.columns if c in ENVELOPE], F.struct(*payload).alias("payload"))


def flatten(df: DataFrame) -> DataFrame:
    """Payload fields as columns; frames without a payload pass through."""
    if "payload" not in df.columns:
        return df
    return df.select(*[c for c in df.columns if c != "payload"], "payload.*")


def with_lineage(df: DataFrame, version: str, parsed_at: str) -> DataFrame:
    return df.withColumns({"_schema_version": F.lit(version), "_parsed_at": F.lit(parsed_at).cast("timestamp")})
