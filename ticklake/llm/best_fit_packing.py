"""Best-fit-decreasing packing into id matrices, with a segment tree over the free capacities.

Every task packs the documents of its own input split, a bounded block at a time, so nothing is shuffled and
memory does not grow with the corpus.  Inside a block the pieces are placed longest first, each into the open
sequence with the least room that still fits it; a segment tree over the capacities finds that room in
O(log capacity).  Overlong documents are cut into full sequences and a rest; joined by ``start`` the pieces
give the document back, bit for bit (``unpacked``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import documents, text_or_empty
from ticklake.llm.tokens import text_blocks, vocabulary_path, word_ids

LENGTH = 2048
CLOSING_ID = 1
BLOCK_TOKENS = 2_000_000


class Capacities:
    """Open sequences by free room; ``best(n)`` is the least room of at least ``n`` that some sequence has."""

    def __init__(self, limit: int):
        self.size = 1 << limit.bit_length()
        self.tree = [0] * (2 * self.size)
        self.at: list[list[int]] = [[] for _ in range(limit + 1)]

    def _change(self, room: int, by: int) -> None:
        node = self.size + room
        while node:
            self.tree[node] += by
            node >>= 1

    def put(self, room: int, sequence: int) -> None:
        self.at[room].append(sequence)
        self._change(room, 1)

    def take(self, room: int) -> int:
        self._change(room, -1)
        return self.at[room].pop()

    def best(self, least: int) -> int | None:
        node = self.size + least
        if self.tree[node]:
            return least
        while node > 1:  # up to the first right neighbour that holds something, then down to its left-most leaf
            if not node & 1 and self.tree[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.tree[2 * node] else 2 * node + 1
                return node - self.size
            node >>= 1
        return None


def best_fit(lengths: list[int], limit: int) -> list[list[int]]:
    """Indexes of ``lengths`` by sequence; longest first, ties in the given order."""
    free, sequences = Capacities(limit), []
    for i in sorted(range(len(lengths)), key=lambda j: -lengths[j]):
        room = free.best(lengths[i])
        if room is None:
            sequences.append([])
            sequence, room = len(sequences) - 1, limit
        else:
            sequence = free.take(room)
        sequences[sequence].append(i)
        if room > lengths[i]:
            free.put(room - lengths[i], sequence)
    return sequences


def _lists(parts: list[list], kind: pa.DataType) -> pa.Array:
    return pa.array(parts, pa.list_(kind))


def _packer(path: str, limit: int, pad: int, closing: int, block: int, kind: pa.DataType):
    def sequences(pieces: list[tuple]) -> pa.RecordBatch:
        rows = best_fit([len(p[2]) for p in pieces], limit)
        ids, segments, resets, docs, starts, used = [], [], [], [], [], []
        for row in rows:
            own = [pieces[i] for i in row]
            line = np.full(limit, pad, "<u4")
            ends = np.cumsum([0, *(len(p[2]) for p in own)])
            places = np.zeros(limit, "<u4")
            for p, a, b in zip(own, ends[:-1], ends[1:], strict=True):
                line[a:b] = p[2]
                places[a:b] = np.arange(b - a)
            ids.append(line.tobytes())
            resets.append(places.tobytes())
            segments.append(ends.tolist())
            docs.append([p[0] for p in own])
            starts.append([p[1] for p in own])
            used.append(int(ends[-1]))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.binary()), pa.array(resets, pa.binary()), _lists(segments, pa.int32()), _lists(docs, kind), _lists(starts, pa.int64()), pa.array(used, pa.int32())],
            names=["ids", "positions", "cu_seqlens", "doc_ids", "starts", "n_tokens"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, held, size = word_ids(path), [], 0
        for batch, texts in text_blocks(batches):
            for row, own in enumerate(encode(texts)):
                own = np.append(own, np.uint32(closing)).astype("<u4")
                doc = batch.column(0)[row].as_py()
                for start in range(0, len(own), limit):
                    held.append((doc, start, own[start : start + limit]))
                    size += len(held[-1][2])
                    if size >= block:
                        yield sequences(held)
                        held, size = [], 0
        if held:
            yield sequences(held)

    return run


def packed_matrices(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, limit: int = LENGTH, pad: int = 0, closing: int = CLOSING_ID,
    block: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row per sequence, ready to be written.

    ``ids``: ``limit`` little-endian unsigned 32-bit ids, padded with ``pad``; ``positions``: as many positions that
    restart at 0 with every segment; ``cu_seqlens``: cumulative segment lengths from 0; ``doc_ids`` and ``starts``:
    the document and the place in it of every segment; ``n_tokens``: ids before the padding.

    A null or empty text is the closing id alone; rows are independent, so repeated rows and null ids are packed like
    others; an empty table gives no sequences; further columns are not read.
    """
    field = docs.select(F.col(id_col).alias("doc_id")).schema["doc_id"].dataType
    kind = pa.int64() if field.simpleString() == "bigint" else pa.int32() if field.simpleString() == "int" else pa.string()
    name = "bigint" if kind == pa.int64() else "int" if kind == pa.int32() else "string"
    rows = docs.select(F.col(id_col).cast(name).alias("doc_id"), text_or_empty(text_col).alias("text"))
    schema = f"ids binary, positions binary, cu_seqlens array<int>, doc_ids array<{name}>, starts array<bigint>, n_tokens int"
    return rows.mapInArrow(_packer(vocabulary or vocabulary_path(), limit, pad, closing, block, kind), schema)


def segments(matrices: DataFrame) -> DataFrame:
    """(doc_id, start, length, ids) of every segment of packed matrices."""
    each = matrices.select("ids", "cu_seqlens", F.posexplode(F.arrays_zip("doc_ids", "starts")).alias("i", "s"))
    first, end = F.col("cu_seqlens")[F.col("i")], F.col("cu_seqlens")[F.col("i") + 1]
    return each.select(F.col("s.doc_ids").alias("doc_id"), F.col("s.starts").alias("start"), (end - first).cast("long").alias("length"), F.substring("ids", first * 4 + 1, (end - first) * 4).alias("ids"))


def unpacked(matrices: DataFrame) -> DataFrame:
    """(doc_id, ids) of whole documents, put together from their segments."""
    parts = segments(matrices).groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "ids"))).alias("parts"))
    joined = F.aggregate("parts", F.lit("").cast("binary"), lambda a, x: F.concat(a, x["ids"]))
    return parts.select("doc_id", joined.alias("ids"))


def write_matrices(matrices: DataFrame, path: str) -> None:
    """Parquet with the binary columns as they are; one file per task."""
    matrices.write.mode("overwrite").parquet(path)


def op4_token_matrices(spark, sf_dir: str) -> DataFrame:
    return packed_matrices(documents(spark, sf_dir))
