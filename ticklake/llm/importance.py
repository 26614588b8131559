"""Importance resampling towards a target distribution, on hashed word runs.

Arrow kernels do the work on text: ``ascii_lower``, ``split_pattern_regex``, ``list_flatten`` and
``dictionary_encode`` make word indices; shifted indices form the longer runs, only distinct runs get a CRC, and
``take`` brings buckets and gains back to the words, summed by document.  Two passes read the texts: one counts the
buckets (a task returns one row a bucket), one sums the gains.  Ranks come from a range-partitioned sort of narrow
rows and the row counts of its partitions, so no task sees all rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake.llm.common import cut, documents, text_or_empty

RUN = 1
BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: bytes of text worked on at a time; a longer text is worked on by itself
SLICE_BYTES = 8_000_000


def _slices(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Runs of about ``SLICE_BYTES`` with their first row."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        end = int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + SLICE_BYTES, "right"))
        end = max(end, start + 1)
        yield start, texts.slice(start, end - start)
        start = end


def word_indices(texts: pa.Array) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Dictionary index of every word, the dictionary, and the row of every word."""
    parts = pc.split_pattern_regex(pc.ascii_lower(texts), pattern=SEPARATORS)
    flat, rows = pc.list_flatten(parts), pc.list_parent_indices(parts)
    solid = pc.greater(pc.binary_length(flat), 0)
    coded = pc.dictionary_encode(flat.filter(solid))
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.cast(pa.binary()).to_pylist(), rows.filter(solid).to_numpy(zero_copy_only=False)


def run_buckets(texts: pa.Array, run: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of run up to ``run``: bucket and row of every run of that many words."""
    index, words, rows = word_indices(texts)
    crc = np.fromiter((zlib.crc32(w) for w in words), np.int64, len(words))  # of every distinct run
    code = index  # by word: the distinct run that starts there
    yield (crc % buckets)[code], rows
    for k in range(2, run + 1):
        starts = np.flatnonzero(rows[: max(0, len(rows) - k + 1)] == rows[k - 1 :])
        pairs, found = np.unique(code[starts] * max(1, len(words)) + index[starts + k - 1], return_inverse=True)
        before, last = np.divmod(pairs, max(1, len(words)))
        crc = np.fromiter((zlib.crc32(b" " + words[b], int(crc[a])) for a, b in zip(before, last, strict=True)), np.int64, len(pairs))
        code = np.zeros(len(index), np.int64)
        code[starts] = found
        yield (crc % buckets)[found], rows[starts]


def bucket_counts(docs: DataFrame, text_col: str = "text", run: int = RUN, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many runs of all texts fall into each bucket; buckets without any are absent."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, texts in _slices(batch.column(0)):
                for found, _rows in run_buckets(texts, run, buckets):
                    total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], names=["bucket", "n"])

    return docs.select(text_or_empty(text_col).alias("text")).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, text_col: str = "text", target_text_col: str = "text", run: int = RUN, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain): thousandths of the smoothed log ratio of a bucket's share in the target and in the documents."""
    spark = docs.sparkSession
    s = bucket_counts(docs, text_col, run, buckets).select("bucket", F.col("n").alias("s"))
    t = bucket_counts(target, target_text_col, run, buckets).select("bucket", F.col("n").alias("t"))
    both = spark.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(s, "bucket", "left").join(t, "bucket", "left").fillna(0, ["s", "t"])
    both = cut(both, "bucket-counts")
    total = both.agg(F.sum("s").cast("double").alias("s_all"), F.sum("t").cast("double").alias("t_all"))  # one row
    ratio = ((F.col("t") + 1.0) * (F.col("s_all") + float(buckets))) / ((F.col("s") + 1.0) * (F.col("t_all") + float(buckets)))
    return both.join(F.broadcast(total)).select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).cast("long").alias("gain"))


def noise(id_col: str, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths from a hash of the id; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    u = (F.conv(F.left(digest, F.lit(8)), 16, 10).cast("long") + 0.5) / 4294967296.0
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u))).cast("long")


def importance(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
    run: int = RUN, buckets: int = BUCKETS, min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED, keep: bool = False,
) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank`` (null where not drawn) of every row of ``docs``.

    Drawn are the floor(``percent`` * N / 100) highest scores of the N rows with at least ``min_words`` words, ties to
    smaller ids, null ids last; rows with the same id and score follow each other in any order.  Null and empty texts
    have no features and weight 0.  Repeated rows are rows like others; an empty target has equal shares everywhere,
    an empty table gives an empty result.  With ``keep`` the row itself comes along as struct ``doc``.
    """
    gains = np.zeros(buckets, np.int64)
    for r in bucket_gains(docs, target, text_col, target_text_col, run, buckets).collect():  # ``buckets`` rows
        gains[r["bucket"]] = r["gain"]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in _slices(batch.column(0)):
                n, n_words, total = (np.zeros(len(texts), np.int64) for _ in range(3))
                for k, (found, rows) in enumerate(run_buckets(texts, run, buckets)):
                    here = np.bincount(rows, minlength=len(texts)).astype(np.int64)
                    n_words = here if k == 0 else n_words
                    n += here
                    # rows come in order: the sum of a row is a difference of running sums
                    ends = np.cumsum(here)
                    sums = np.concatenate([[0], np.cumsum(gains[found])])
                    total += sums[ends] - sums[ends - here]
                weight = np.where(n > 0, np.floor_divide(total, np.maximum(n, 1)), 0)
                made = [pa.array(x, pa.int64()) for x in (n_words, n, weight)]
                yield pa.RecordBatch.from_arrays([*[c.slice(start, len(texts)) for c in batch.columns[1:]], *made], names=[*batch.schema.names[1:], "n_words", "n_features", "weight"])

    wanted = [text_or_empty(text_col).alias("_text"), F.col(id_col).alias("doc_id"), *([F.struct("*").alias("doc")] if keep else [])]
    rows = docs.select(*wanted)
    schema = rows.drop("_text").schema.add("n_words", "long").add("n_features", "long").add("weight", "long")
    scored = rows.mapInArrow(weigh, schema).withColumn("score", F.col("weight") + noise("doc_id", seed))
    scored = cut(scored, "scored")
    large = F.col("n_words") >= min_words
    draws = scored.where(large).count() * percent // 100
    # equal keys are told apart by a number, or a third of all rows could fall to one task
    tie = F.xxhash64(F.monotonically_increasing_id())
    order = [F.desc("_large"), F.desc("score"), F.asc_nulls_last("doc_id"), "n_features", "_tie"]
    placed = scored.withColumns({"_large": large, "_tie": tie}).orderBy(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = cut(placed.drop("_tie"), "placed")
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).count()  # a row for each partition of the sort
    before = sizes.select("_part", F.coalesce(F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    rank = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    ranked = placed.withColumn("_part", part).join(F.broadcast(before), "_part")
    return ranked.select("doc_id", "n_features", "weight", "score", F.when(F.col("_large") & (rank <= draws), rank).alias("rank"), *(["doc"] if keep else []))


def resampled(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn rows of ``docs``, all columns; see ``importance``."""
    return importance(docs, target, keep=True, **options).where("rank is not null").select("doc.*")


def op12_importance(spark, sf_dir: str) -> DataFrame:
    return importance(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


#: CRC-32 of the bytes whose hexadecimal text is ``x``, with the table of 256 remainders as ``tbl``
CRC_SQL = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(len(x) // 2), lambda i: ('0x' || x[2 * i + 1 : 2 * i + 2])::BIGINT)),
 lambda c, y: xor(c >> 8, tbl[(xor(c, y) & 255) + 1])), 4294967295::BIGINT)"""
CRC_TABLE_SQL = """crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n::BIGINT, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)) AS tbl)"""

OP12_SQL = rf"""
WITH {CRC_TABLE_SQL},
w AS (SELECT 0 AS side, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM documents
      UNION ALL SELECT 1, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark),
v AS (SELECT word, {CRC_SQL} % 10000 AS bucket FROM (SELECT word, hex(encode(word)) AS x FROM (SELECT DISTINCT word FROM w)), crc),
c AS (SELECT bucket, count_if(side = 0) AS s, count_if(side = 1) AS t FROM w JOIN v USING (word) GROUP BY 1),
g AS (SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (s_all + 10000)) / ((s + 1)::DOUBLE * (t_all + 10000))))::BIGINT AS gain FROM c, (SELECT sum(s)::DOUBLE AS s_all, sum(t)::DOUBLE AS t_all FROM c)),
f AS (SELECT doc_id, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM w JOIN v USING (word) JOIN g USING (bucket) WHERE side = 0 GROUP BY 1),
z AS (SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
      floor(-1000 * ln(-ln((('0x' || left(sha256('2024:' || d.doc_id), 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS noise FROM documents d LEFT JOIN f USING (doc_id)),
r AS (SELECT *, weight + noise AS score, n_features >= 20 AS large FROM z),
o AS (SELECT *, row_number() OVER (PARTITION BY large ORDER BY score DESC, doc_id) AS nr FROM r)
SELECT doc_id, n_features, weight, score, CASE WHEN large AND nr <= (SELECT count(*) * 10 // 100 FROM r WHERE large) THEN nr END AS rank FROM o
"""
