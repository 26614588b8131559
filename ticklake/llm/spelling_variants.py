"""Spelling variants: words one edit apart, grouped under their most frequent form.

Words are counted with combining before the shuffle.  Two words are one edit apart exactly where the length of their
common prefix plus that of their common suffix reaches the longer length minus one.  Candidates meet in blocks: the
shorter length is cut into ``SEGMENTS`` stretches, an edit falls into one of them, and what lies before and after that
stretch is equal in both words, so it is the block's key.  Words of a block become padded matrices of code points, one
read from the front and one from the back, and whole tiles of pairs are compared column by column.  A block of over
``TILE`` words is dealt into tiles by hash, and every pair of its tiles is a unit of work of its own, so no task needs
a whole block; units give back one row a word with what it found, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import A_TO_Z, cut, documents, text_or_empty
from ticklake.llm.importance import CRC_SQL, CRC_TABLE_SQL

RUN = "[A-Za-zÀ-ÿ]+"
MIN_LENGTH = 5
MIN_COUNT = 3
SLIP = 97
RATIO = 2
SEGMENTS = 3
TILE = 512
#: pairs compared at a time
PAIRS = 2_000_000


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, slip: int = SLIP) -> DataFrame:
    """(word, n): runs of letters, lower-cased (A-Z only); where ``slip`` divides the checksum of id and run, one code
    point of it is missing.  Words of at least ``min_length`` code points that occur at least ``min_count`` times."""
    runs = F.regexp_extract_all(F.translate(text_or_empty(text_col), *A_TO_Z), F.lit(RUN), F.lit(0))
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run")).where(F.length("run") >= min_length)
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = F.pmod(h, F.length("run")).cast("int")
    word = F.when(h % slip == 0, F.concat(F.left("run", at), F.substring(F.col("run"), at + 2, F.length("run")))).otherwise(F.col("run"))
    return rows.select(word.alias("word")).where(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def segment(length: Column, i: Column, segments: int) -> Column:
    """Where stretch ``i`` of a word of that length begins."""
    return F.floor(length * i / segments).cast("int")


def _blocks(words: DataFrame, segments: int) -> DataFrame:
    """(block, size, i, word, n): every word once for each stretch, as the shorter and as the longer word of a pair."""
    size = F.explode(F.array(F.length("word"), F.length("word") - 1))
    rows = words.withColumn("size", size).where("size > 0").withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(segments - 1))))
    begin, end = segment(F.col("size"), F.col("i"), segments), segment(F.col("size"), F.col("i") + 1, segments)
    tail = F.col("size") - end
    key = F.concat_ws(":", "size", "i", F.left("word", begin), F.right("word", tail))
    return rows.select(key.alias("block"), "size", "i", "word", "n")


def _units(blocks: DataFrame, tile: int) -> DataFrame:
    """Blocks as units of at most two tiles: (unit, size, i, side, word, n), side 0 and 1 where two tiles meet, else 2."""
    counts = blocks.groupBy("block").count().where("count > 1")
    rows = blocks.join(counts, "block").withColumn("tiles", F.ceil(F.col("count") / tile).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    side = F.when(F.col("own") == F.col("other"), 2).otherwise((F.col("own") > F.col("other")).cast("int"))
    unit = F.concat_ws(":", "block", F.least("own", "other"), F.greatest("own", "other"))
    return rows.select(unit.alias("unit"), "size", "i", side.cast("int").alias("side"), "word", "n")


def code_points(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Padded matrices of the words' code points plus one, from the front and from the back."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32) + 1
    kind = np.uint8 if not len(flat) or flat.max() < 256 else np.uint32  # narrow columns compare faster
    row = np.repeat(np.arange(len(words)), lengths)
    column = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    front, back = np.zeros((len(words), width), kind), np.zeros((len(words), width), kind)
    front[row, column] = flat
    back[row, lengths[row] - 1 - column] = flat
    return front, back


def _common(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Length of the common prefix of every row of ``x`` with every row of ``y``, tile by tile."""
    run = np.ones((x.shape[0], x.shape[1], y.shape[1]), bool)
    total = np.zeros(run.shape, np.uint16)
    for j in range(x.shape[2]):
        run &= x[:, :, None, j] == y[:, None, :, j]
        if not run.any():
            break
        total += run
    return total


def _compare(size: int, i: int, segments: int, a: np.ndarray, b: np.ndarray, within: bool, front: np.ndarray, back: np.ndarray, lengths: np.ndarray):
    """Pairs of rows one edit apart; ``a`` and ``b`` hold rows by unit, -1 where a unit has fewer."""
    prefix, suffix = _common(front[a], front[b]).astype(np.int32), _common(back[a], back[b]).astype(np.int32)
    la, lb = lengths[a][:, :, None], lengths[b][:, None, :]
    longer = np.maximum(la, lb)
    near = (a >= 0)[:, :, None] & (b >= 0)[:, None, :] & (np.minimum(la, lb) == size) & (longer <= size + 1) & (prefix + suffix >= longer - 1)
    if within:
        near &= np.triu(np.ones(near.shape[1:], bool), 1)[None]
    u, r, c = np.nonzero(near)
    # a pair counts in the first of the stretches that may hold its edit
    p, s = prefix[u, r, c], suffix[u, r, c]
    first = np.full(len(u), segments)
    for k in range(segments - 1, -1, -1):
        first = np.where((size * k // segments <= p) & (size - size * (k + 1) // segments <= s), k, first)
    mine = first == i
    return a[u[mine], r[mine]], b[u[mine], c[mine]]


def _near_rows(words: list[str], starts: np.ndarray, ends: np.ndarray, size: np.ndarray, i: np.ndarray, side: np.ndarray, segments: int):
    """Pairs of rows one edit apart, over all units; rows of a unit stand together, sorted by side."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    front, back = code_points(words, int(lengths.max()))
    ones = np.array([np.searchsorted(side[s:e], 1) for s, e in zip(starts, ends, strict=True)])
    within = side[starts] == 2
    left, right = np.where(within, ends - starts, ones), np.where(within, ends - starts, ends - starts - ones)
    shift = np.where(within, 0, ones)
    widest = np.maximum(left, right)
    solid = (left > 0) & (right > 0) & ~(within & (left < 2))
    padded = np.where(solid, 2 ** np.ceil(np.log2(np.maximum(widest, 2))).astype(np.int64), 0)
    groups = np.stack([size[starts], i[starts], within.astype(np.int64), padded], axis=1)
    for g in np.unique(groups[solid], axis=0):
        mine = np.flatnonzero((groups == g).all(axis=1) & solid)
        wide = int(g[3])
        step = max(1, PAIRS // (wide * wide))
        for k in range(0, len(mine), step):
            units = mine[k : k + step]
            column = np.arange(wide)[None, :]
            a = np.where(column < left[units][:, None], starts[units][:, None] + column, -1)
            b = a if g[2] else np.where(column < right[units][:, None], (starts + shift)[units][:, None] + column, -1)
            yield _compare(int(g[0]), int(g[1]), segments, a, b, bool(g[2]), front, back, lengths)


def _matcher(segments: int):
    def emit(table: dict) -> pa.RecordBatch | None:
        unit, words, n = table["unit"], table["word"], np.array(table["n"], np.int64)
        change = np.flatnonzero([True, *(x != y for x, y in zip(unit, unit[1:], strict=False))])
        ends = np.append(change[1:], len(unit))
        made = list(_near_rows(words, change, ends, *(np.array(table[c], np.int64) for c in ("size", "i", "side")), segments))
        a, b = (np.concatenate([x[k] for x in made]) if made else np.zeros(0, np.int64) for k in (0, 1))
        if not len(a):
            return None
        own, other = np.concatenate([a, b]), np.concatenate([b, a])
        # of every row the near words' number and the best one: largest n, then first in code-point order
        alphabetical = np.empty(len(words), np.int64)
        alphabetical[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
        order = np.lexsort((alphabetical[other], -n[other], own))
        rows, at, counts = np.unique(own[order], return_index=True, return_counts=True)
        best = other[order][at]
        columns = [pa.array([words[r] for r in rows]), pa.array(counts, pa.int64()), pa.array(n[best], pa.int64()), pa.array([words[r] for r in best])]
        return pa.RecordBatch.from_arrays(columns, names=["word", "n_near", "best_n", "best"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict | None = None
        for batch in batches:
            new = batch.to_pydict()
            held = new if held is None else {c: held[c] + new[c] for c in new}
            if not held["unit"]:
                continue
            # the last unit may go on in the next batch
            last = held["unit"][-1]
            end = next((k for k in range(len(held["unit"]) - 1, -1, -1) if held["unit"][k] != last), -1) + 1
            if end:
                made = emit({c: v[:end] for c, v in held.items()})
                if made is not None:
                    yield made
                held = {c: v[end:] for c, v in held.items()}
        if held and held["unit"]:
            made = emit(held)
            if made is not None:
                yield made

    return run


def near_words(words: DataFrame, segments: int = SEGMENTS, tile: int = TILE) -> DataFrame:
    """(word, n_near, best_n, best): of every (word, n) that has near words, their number and the one of largest n."""
    units = _units(_blocks(words, segments), tile)
    dealt = units.repartition("unit").sortWithinPartitions("unit", "side", "word")
    found = dealt.mapInArrow(_matcher(segments), "word string, n_near long, best_n long, best string")
    # the smallest of (-n, word) is the largest n, first in code-point order
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word")))
    each = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    return each.select("word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms are followed to the last.  Steps double, so a chain of k forms takes log2(k)
    rounds; n at least doubles with every form, so chains are short."""
    known = cut(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = known.select(F.col("word").alias("root"), F.col("root").alias("further"))
        known = cut(known.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if known.where("moved").isEmpty():
            return known.drop("moved")


def spelling_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, slip: int = SLIP, ratio: int = RATIO,
    segments: int = SEGMENTS, tile: int = TILE,
) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` of every word.

    The form is the near word of largest n (ties: first in code-point order) if that is at least ``ratio`` times the
    word's own; without one the word is its own root.  Null and empty texts have no words; a null id counts as an
    empty one; repeated rows count again.  An empty table gives an empty result; further columns are not read.
    """
    words = cut(word_counts(docs, id_col, text_col, min_length, min_count, slip), "words")
    near = near_words(words, segments, tile)
    formed = F.col("best_n") >= ratio * F.col("n")
    rows = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n")
    )
    rows = cut(rows, "forms")
    found = roots(rows.where("form is not null"))
    return rows.join(found, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op13_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir))


OP13_SQL = rf"""
WITH RECURSIVE {CRC_TABLE_SQL},
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
dr AS (SELECT doc_id, run, count(*) AS k FROM runs WHERE length(run) >= 5 GROUP BY ALL),
h AS (SELECT run, k, {CRC_SQL} AS h FROM (SELECT run, k, hex(encode(doc_id || ':' || run)) AS x FROM dr), crc),
s AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, k FROM h),
w AS (SELECT word, sum(k)::BIGINT AS n FROM s WHERE length(word) >= 5 GROUP BY 1 HAVING sum(k) >= 3),
del AS (SELECT word, n, i, left(word, i::INT) || substr(word, i::INT + 2) AS rest FROM (SELECT *, unnest(range(length(word))) AS i FROM w)),
near AS (SELECT a.word, b.word AS other, b.n FROM del a JOIN del b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
         UNION SELECT d.word, w.word, w.n FROM del d JOIN w ON d.rest = w.word UNION SELECT w.word, d.word, d.n FROM del d JOIN w ON d.rest = w.word),
b AS (SELECT word, count(*) OVER (PARTITION BY word) AS n_near, other, n AS best_n, row_number() OVER (PARTITION BY word ORDER BY n DESC, other) AS nr FROM near),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * w.n THEN other END AS form, CASE WHEN best_n >= 2 * w.n THEN best_n END AS form_n
      FROM w LEFT JOIN b ON w.word = b.word AND nr = 1),
r(word, root) AS (SELECT word, word FROM f UNION ALL SELECT r.word, f.form FROM r JOIN f ON r.root = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, r.root FROM f JOIN r USING (word) JOIN f g ON r.root = g.word AND g.form IS NULL
"""
