"""Exact deduplication: 128-bit content hash, one stable survivor per group, byte comparison.

Rows are grouped by a 128-bit hash of the normalised text; only (hash, id) pairs enter that shuffle and they
are combined map-side, so a text that a third of all rows share is a handful of partial counts.  The text of
each group's survivor is then joined to the rows and compared byte by byte.  The join reads two shuffles
directly, so the adaptive skew join splits a hot group over many tasks.  Rows that share a hash but not the
bytes are grouped anew by the bytes themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import A_TO_Z, cut, documents, keep_rows, quoted, text_or_empty


def content_hash(data: bytes) -> bytes:
    """The 128-bit hash that forms the groups."""
    return xxhash.xxh3_128_digest(data)


def _hasher(hash128: Callable[[bytes], bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for start in range(0, batch.num_rows, 512):
                normal = [t.as_py().encode().lower() for t in texts.slice(start, 512)]  # bytes.lower() changes A-Z only
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(start, 512),
                        pa.array([hash128(x) for x in normal], pa.binary()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in normal], pa.string()),
                        pa.array(normal, pa.binary()),
                    ],
                    names=["id", "hash", "sha", "bytes"],
                )

    return run


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", hash128: Callable[[bytes], bytes] = content_hash
) -> DataFrame:
    """One row per input row: ``id_col``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when their UTF-8 bytes are equal after lower-casing A-Z.  ``keep`` names the surviving id of
    a group, ``smallest`` or ``largest``.  A null text counts as empty, and all empty texts form one group.
    Rows that repeat the surviving id with the same text are one document and all stay.  A null id never
    survives beside an id; a group of null ids only has a null ``keep_id`` and all its rows stay.  An empty
    table gives an empty result; further columns of ``docs`` are not read.
    """
    best = {"smallest": F.min, "largest": F.max}[keep]
    kind = docs.schema[id_col].dataType.simpleString()
    hashed = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).mapInArrow(
        _hasher(hash128), f"id {kind}, hash binary, sha string, bytes binary"
    )
    groups = hashed.groupBy("hash").agg(F.count("*").alias("n"), best("id").alias("keep_id")).where("n > 1")
    groups = cut(groups, "exact-groups")
    # the survivor's bytes, one row per group even where its row is repeated
    survivors = (
        hashed.select("id", F.col("hash").alias("h"), "bytes")
        .join(groups.hint("merge"), (F.col("h") == F.col("hash")) & (F.col("id") == F.col("keep_id")))
        .select("hash", "n", "keep_id", F.col("bytes").alias("kept_bytes"))
    )
    # dropDuplicates over the hash alone suffices, as any row of the surviving id may stand for the group
    survivors = cut(survivors, "exact-survivors").dropDuplicates(["hash"])
    survivors = groups.select("hash", "n", "keep_id").join(survivors.select("hash", "kept_bytes"), "hash", "left")
    survivors = cut(survivors, "exact-compare")

    # both joins shuffle whatever the size: the groups grow with the corpus and are never broadcast
    compared = hashed.join(survivors.hint("merge"), "hash", "left")
    same = F.col("n").isNull() | F.col("kept_bytes").isNull() | (F.col("bytes") == F.col("kept_bytes"))
    compared = compared.select(
        "id", "hash", "sha", F.coalesce("n", F.lit(1)).alias("n"),
        F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(~same, F.col("bytes")).alias("stray"),
    )
    compared = cut(compared, "exact-compared")

    strays = compared.where("stray is not null")
    classes = strays.groupBy("hash", "stray").agg(F.count("*").alias("stray_n"), best("id").alias("stray_keep"))
    strayed = strays.groupBy("hash").agg(F.count("*").alias("lost"))
    equal = (
        compared.where("stray is null")
        .join(F.broadcast(strayed) if _few(strayed) else strayed, "hash", "left")
        .select("id", "keep_id", (F.col("n") - F.coalesce("lost", F.lit(0))).alias("n"), "sha")
    )
    other = strays.join(classes, ["hash", "stray"]).select("id", F.col("stray_keep").alias("keep_id"), F.col("stray_n").alias("n"), "sha")
    return equal.unionByName(other).select(
        F.col("id").alias(id_col), "keep_id", F.col("n").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256"),
    )


def _few(strayed: DataFrame, bound: int = 10_000) -> bool:
    """Collisions of a 128-bit hash practically never occur: the size is checked before it is broadcast."""
    return strayed.limit(bound + 1).count() <= bound


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """Rows of ``docs`` that survive, with all their columns as they are.

    A row is known by its id and text: one whose text another id keeps goes, even where its id survives with another
    text.  Null and empty texts are one group, of which one id stays; rows with a null id stay only where no id has
    their text.  Repeated rows stay or go together, an empty table stays empty, and names of further columns do not
    matter.
    """
    kept = exact_groups(docs, id_col, text_col, keep).where("kept").select(id_col, "text_sha256")
    text = F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit(""))
    return keep_rows(docs, kept, id_col, F.sha2(F.translate(text, *A_TO_Z).cast("binary"), 256))


def op7_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir), keep="largest").select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


#: DuckDB's lower() changes more than A-Z, hence translate().
OP7_SQL = """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g USING (t)
"""
