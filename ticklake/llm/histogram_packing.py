"""Shortest-pack-first packing over the histogram of lengths.

Documents become token ids and one closing id; what exceeds a sequence is cut into full sequences and a rest.
The planner sees only the histogram (at most one row per length up to the limit, whatever the corpus holds): it
takes the lengths longest first and puts each into the pattern with the most room, where it fits, updating
how often every pattern occurs.  Patterns then meet the pieces by rank: the r-th piece of a length takes the
r-th place of that length.  No piece is looked at one by one on the driver and no task holds more than its
share: ranks come from counts per (length, slot) and a numbering inside a slot.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticklake.llm.common import cut, documents, text_or_empty
from ticklake.llm.tokens import text_blocks, vocabulary_path, word_ids

LENGTH = 2048
CLOSING_ID = 1
SLOTS = 1024  # numbering tasks that one length can use


def _piecer(path: str, limit: int, closing: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_ids(path)
        for batch, texts in text_blocks(batches):
            rows, starts, lengths, ids, totals = [], [], [], [], []
            for row, own in enumerate(encode(texts)):
                own = np.append(own, np.uint32(closing)).astype("<u4")
                for start in range(0, len(own), limit):
                    part = own[start : start + limit]
                    rows.append(row)
                    starts.append(start)
                    lengths.append(len(part))
                    ids.append(part.tobytes())
                    totals.append(len(own))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(ids, pa.binary()), pa.array(totals, pa.int64())],
                names=["doc_id", "start", "length", "ids", "doc_tokens"],
            )

    return run


def token_pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, limit: int = LENGTH, closing: int = CLOSING_ID
) -> DataFrame:
    """Pieces of at most ``limit`` tokens: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens.

    A null or empty text is the closing id alone.  Rows are independent of each other, so repeated rows and null
    ids give pieces like any other row; further columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    schema = f"doc_id {kind}, start long, length long, ids binary, doc_tokens long"
    return rows.mapInArrow(_piecer(vocabulary or vocabulary_path(), limit, closing), schema)


def plan_patterns(histogram: dict[int, int], limit: int = LENGTH) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """[(times, ((length, how many of it in a sequence), ...))] that place every length of the histogram.

    Longest first; each goes into the pattern with the most room.  Patterns with the same room are kept in a
    heap by room, so one step places as many pieces as the pattern occurs.  A pattern takes as many of a length
    as it has room for before the next pattern is opened.
    """
    heap: list[tuple[int, int, int, tuple]] = []  # (-room, order, times, pattern)
    done, order = [], 0
    for length in sorted((n for n, c in histogram.items() if c > 0), reverse=True):
        left = histogram[length]
        while left:
            if heap and -heap[0][0] >= length:
                room, _, times, pattern = heapq.heappop(heap)
                room = -room
                used = min(times, left)
                if used < times:
                    order += 1
                    heapq.heappush(heap, (-room, order, times - used, pattern))
                many = 1
            else:
                room, pattern = limit, ()
                fits = limit // length
                many = min(fits, left)
                used = left // many
            left -= used * many
            room -= many * length
            pattern = _added(pattern, length, many)
            if room:
                order += 1
                heapq.heappush(heap, (-room, order, used, pattern))
            else:
                done.append((used, pattern))
    return done + [(times, pattern) for _, _, times, pattern in sorted(heap, key=lambda x: x[1])]


def _added(pattern: tuple, length: int, many: int) -> tuple:
    if pattern and pattern[-1][0] == length:
        return (*pattern[:-1], (length, pattern[-1][1] + many))
    return (*pattern, (length, many))


def places(patterns: list[tuple[int, tuple]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, one past the last, many, first sequence, offset) of each length of each pattern."""
    rank: dict[int, int] = {}
    rows, sequence = [], 0
    for times, pattern in patterns:
        offset = 0
        for length, many in pattern:
            first = rank.get(length, 0)
            rank[length] = first + times * many
            rows.append((length, first, rank[length], many, sequence, offset))
            offset += length * many
        sequence += times
    return rows


def ranked(pieces: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``pieces`` with ``rank`` from 0 among those of a length; a frequent length is numbered in ``slots`` tasks."""
    slot = F.pmod(F.xxhash64("doc_id", "start"), F.lit(slots)).cast("int")
    cells = pieces.withColumn("slot", slot)
    counts = cells.groupBy("length", "slot").agg(F.count("*").alias("c"))
    before = F.sum("c").over(Window.partitionBy("length").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("length", "slot", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("length", "slot").orderBy("doc_id", "start")) - 1
    cells = cells.withColumn("inside", inside).join(counts, ["length", "slot"])
    return cells.withColumn("rank", F.col("before") + F.col("inside")).drop("slot", "inside", "before")


def pack_pieces(pieces: DataFrame, limit: int = LENGTH) -> DataFrame:
    """``pieces`` (doc_id, start, length, ...) with ``sequence_id`` and ``offset``, gapless from 0.

    Sequence ids run from 0 without gaps.  Repeated pieces get places of their own.  An empty table stays empty.
    ``pieces`` is evaluated three times: pass a stored table.
    """
    spark = pieces.sparkSession
    # at most ``limit`` rows, as no piece is longer than a sequence
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows = places(plan_patterns(histogram, limit))
    table = spark.createDataFrame(rows or [(0, 0, 0, 1, 0, 0)], "_length long, _first long, _end long, _many long, _sequence long, _offset long")
    # a handful of rows per length of the histogram, bounded by the limit and not by the corpus
    placed = ranked(pieces).join(F.broadcast(table), (F.col("length") == F.col("_length")) & (F.col("rank") >= F.col("_first")) & (F.col("rank") < F.col("_end")))
    nth = F.col("rank") - F.col("_first")
    sequence = F.col("_sequence") + F.floor(nth / F.col("_many"))
    offset = F.col("_offset") + F.col("length") * (nth % F.col("_many"))
    return placed.select(*pieces.columns, sequence.cast("long").alias("sequence_id"), offset.cast("long").alias("offset"))


def packed(docs: DataFrame, **options) -> DataFrame:
    """Pieces with their ids and places; ordered by offset the ids of a sequence are its tokens."""
    limit = options.get("limit", LENGTH)
    return pack_pieces(cut(token_pieces(docs, **options), "pieces"), limit)


def pack_report(docs: DataFrame) -> DataFrame:
    """Pieces with the checksum of their ids in place of the ids, packed."""
    pieces = token_pieces(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return pack_pieces(cut(pieces, "pieces"))


def op2_packing(spark, sf_dir: str) -> DataFrame:
    return pack_report(documents(spark, sf_dir))
