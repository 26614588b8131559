"""Benchmark decontamination: a broadcast hash set of the windows of all benchmark items.

Texts are lower-cased (A-Z only) and cut into words.  Every ``WINDOW`` consecutive words of an item are one window, an
item of fewer words is one window of what it has.  The windows' hashes are broadcast; each document's windows are
hashed and looked up in the same task, so documents are never shuffled, and a hit counts after its words were
compared with the window's.  Only hits, and one narrow row a document, leave the task.

The broadcast holds at most ``SET_WINDOWS`` windows.  A larger benchmark is cut by hash into several such sets, each
looked up in a pass of its own over the documents; results are the same.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import A_TO_Z, cut, documents, free, quoted, text_or_empty

WINDOW = 10
#: windows in one broadcast, about 100 bytes each
SET_WINDOWS = 250_000
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: the same runs in a text that is not lower-cased
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: stands for the document itself among its windows
DOCUMENT = -7_046_029_254_386_353_131


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, *A_TO_Z), F.lit(WORD), F.lit(0))


def window_hashes(word_hashes: str, size: Column, width: int) -> Column:
    """Hash of every run of ``width`` words."""
    at = lambda i, k: F.get(F.col(word_hashes), i + F.lit(k))
    rolled = F.transform(F.sequence(F.lit(0), size - width), lambda i: F.xxhash64(*[at(i, k) for k in range(width)]))
    return F.when(size >= width, rolled).otherwise(F.array().cast("array<bigint>"))


def item_windows(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(item, window): the distinct windows of every item as words joined by a blank; items without words have none."""
    rows = benchmark.select(F.col(item_col).alias("item"), words(text_or_empty(text_col)).alias("w"))
    width = F.least(F.size("w"), F.lit(window))
    made = F.transform(F.sequence(F.lit(1), F.size("w") - width + 1), lambda i: F.array_join(F.slice("w", i, width), " "))
    return rows.where(F.size("w") > 0).select("item", F.explode(made).alias("window")).distinct()


def _window_set(found: DataFrame) -> DataFrame:
    """(wid, width, hash, window) of the distinct windows; the hash is the one of ``window_hashes``."""
    rows = found.select("window").distinct().withColumn("h", F.transform(F.split("window", " "), lambda w: F.xxhash64(w)))
    widths = [r["n"] for r in rows.select(F.size("h").alias("n")).distinct().collect()]  # at most the width of a window
    by_width = reduce(lambda c, n: c.when(F.size("h") == n, F.get(window_hashes("h", F.size("h"), n), 0)), widths, F.when(F.lit(False), F.lit(0).cast("bigint")))
    return cut(rows.select(F.monotonically_increasing_id().alias("wid"), F.size("h").alias("width"), by_width.alias("hash"), "window"), "windows")


def _hits(rows: DataFrame, known: DataFrame, widths: list[int]) -> DataFrame:
    """A row for every occurrence of a known window (``at``, ``width``, ``wid``) and one with nulls for every document."""
    own = known.sparkSession.createDataFrame([(None, None, DOCUMENT, None)], known.schema)
    known = known.unionByName(own).withColumnsRenamed({"hash": "_hash", "wid": "_wid"})
    df = rows.withColumn("w", words(F.col("text"))).withColumn("h", F.transform("w", lambda w: F.xxhash64(w)))
    df = df.withColumn("n_words", F.size("w"))
    made = F.concat(F.array(F.lit(DOCUMENT)), *[window_hashes("h", F.size("h"), n) for n in widths])
    df = df.select("rid", "doc_id", "text_key", "n_words", "w", F.posexplode_outer(made).alias("slot", "hash"))
    # where the windows of one width begin among a document's slots
    begins, start = [], F.lit(1)
    for n in widths:
        begins.append(start)
        start = start + F.greatest(F.col("n_words") - (n - 1), F.lit(0))
    at = reduce(lambda c, x: c.when(F.col("width") == x[0], F.col("slot") - x[1]), zip(widths, begins, strict=True), F.when(F.lit(False), F.lit(0)))
    same = F.array_join(F.slice("w", at + 1, F.col("width")), " ") == F.col("window")
    mine = (F.col("slot") == 0) & F.col("width").isNull()
    in_place = (F.col("slot") > 0) & (at >= 0) & (at + F.col("width") <= F.col("n_words"))
    found = df.join(F.broadcast(known), df["hash"] == known["_hash"]).where(mine | (F.when(in_place, same).otherwise(False)))
    return found.select("rid", "doc_id", "text_key", "n_words", F.when(F.col("width").isNotNull(), at).alias("at"), "width", F.col("_wid").alias("wid"))


def _merged(hits: Column) -> Column:
    """Sorted (at, width) runs as disjoint spans of words (start, end), end exclusive."""
    start = F.array().cast("array<struct<start:int,end:int>>")

    def add(spans: Column, h: Column) -> Column:
        last, end = F.try_element_at(spans, F.lit(-1)), h["at"] + h["width"]
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], end).alias("end"))
        new = F.struct(h["at"].alias("start"), end.alias("end"))
        return F.when(F.size(spans) == 0, F.array(new)).when(h["at"] <= last["end"], F.concat(F.slice(spans, 1, F.size(spans) - 1), F.array(joined))).otherwise(F.concat(spans, F.array(new)))

    return F.aggregate(F.sort_array(hits), start, add)


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """For every row of ``docs``: ``doc_id``, ``text_key`` (md5 of the text), ``n_words``, ``n_hit``, ``n_items``, ``items``
    (the item ids as sorted texts), ``spans`` (disjoint runs of hit words) and ``contaminated``.

    A null or empty text has no words and no hits.  Repeated rows and rows without id are rows like others.  An item
    without words is never found; the hits of an item without id count, but it is not listed.  An empty benchmark
    leaves every document clean, an empty table gives an empty result; further columns are not read.
    """
    windows = cut(item_windows(benchmark, item_col, item_text_col, window), "item-windows")
    known = _window_set(windows)
    sizes = {r["width"]: r["count"] for r in known.groupBy("width").count().collect()}
    parts = max(1, -(-sum(sizes.values()) // SET_WINDOWS))
    text = text_or_empty(text_col)
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"), F.md5(text.cast("binary")).alias("text_key"), text.alias("text"))
    rows = rows if parts == 1 else cut(rows, "numbered")  # the passes must agree on the numbers
    passes = [_hits(rows, known.where(F.pmod("hash", F.lit(parts)) == k) if parts > 1 else known, sorted(sizes)) for k in range(parts)]
    hit = F.when(F.col("at").isNotNull(), F.struct("at", "width", "wid"))
    each = reduce(DataFrame.unionByName, passes).groupBy("rid").agg(
        F.first("doc_id").alias("doc_id"), F.first("text_key").alias("text_key"), F.first("n_words").alias("n_words"), F.collect_list(hit).alias("hits")
    )
    each = cut(each.withColumn("spans", _merged(F.col("hits"))).withColumn("wids", F.array_distinct(F.col("hits.wid"))).drop("hits"), "hits")
    listed = windows.where("item is not null").join(known.select("window", "wid"), "window").select("wid", F.col("item").cast("string").alias("item"))
    hot = each.where(F.size("wids") > 0).select("rid", F.explode("wids").alias("wid"))
    items = hot.join(listed, "wid").select("rid", "item").distinct().groupBy("rid").agg(F.sort_array(F.collect_list("item")).alias("items"))
    n_hit = F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"]).cast("long")
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    return each.join(items, "rid", "left").select(
        "doc_id", "text_key", F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"), F.size(items_of).cast("long").alias("n_items"),
        items_of.alias("items"), "spans", (n_hit > 0).alias("contaminated"),
    )


def _without(own: str, between: str, spans: str) -> Column:
    """The text of the words ``own`` and what stands ``between`` them, without the words of ``spans`` and what follows
    each of them up to the next word.  The arrays are columns: as expressions they would be made anew for every word."""
    gone = F.flatten(F.transform(spans, lambda s: F.sequence(s["start"], s["end"] - 1)))
    kept = F.array_except(F.sequence(F.lit(0), F.size(own) - 1), gone)
    return F.concat(F.get(F.col(between), F.lit(0)), F.array_join(F.transform(kept, lambda i: F.concat(F.get(F.col(own), i), F.get(F.col(between), i + 1))), ""))


def decontaminated(docs: DataFrame, benchmark: DataFrame, remove: str = "spans", id_col: str = "doc_id", text_col: str = "text", **columns) -> DataFrame:
    """``docs``, all columns, without hit words (``remove="spans"``) or without the documents that have any (``"documents"``).

    A row is known by its id and text, so repeated rows and rows without id are treated alike.  Clean rows, null and
    empty texts among them, stay as they are; the names of further columns do not matter.
    """
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove: {remove}")
    found_id, found_key, spans, own, between = (free(name, docs.columns) for name in ("found_id", "found_key", "spans", "own", "between"))
    found = contamination(docs, benchmark, id_col, text_col, **columns).where("contaminated")
    found = cut(found.groupBy(F.col("doc_id").alias(found_id), F.col("text_key").alias(found_key)).agg(F.first("spans").alias(spans)), "contaminated")
    text = docs[quoted(text_col)]
    same = docs[quoted(id_col)].eqNullSafe(found[found_id]) & (F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")) == found[found_key])
    if remove == "documents":
        return docs.join(found, same, "left_anti")
    hit = F.when(F.col(spans).isNotNull(), F.col(quoted(text_col)))
    rows = docs.join(found, same, "left").withColumns({own: F.regexp_extract_all(hit, F.lit(RAW_WORD), F.lit(0)), between: F.split(hit, RAW_WORD)})
    cleaned = F.when(F.col(spans).isNull(), F.col(quoted(text_col))).otherwise(_without(own, between, spans))
    return rows.select(*[cleaned.alias(c) if c == text_col else F.col(quoted(c)) for c in docs.columns])


def op11_decontamination(spark, sf_dir: str) -> DataFrame:
    found = contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


OP11_SQL = r"""
WITH a AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS u, 'abcdefghijklmnopqrstuvwxyz' AS l, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+' AS p),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), u, l), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents, a),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), u, l), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark, a),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i + 1 : i + least(len(w), 10)], ' ') AS win
       FROM (SELECT *, unnest(range(len(w) - least(len(w), 10) + 1)) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, i, k, array_to_string(w[i + 1 : i + k], ' ') AS win FROM (SELECT doc_id, w, k, unnest(range(len(w) - k + 1)) AS i FROM d, ks WHERE len(w) >= k)),
h AS (SELECT doc_id, i, k, item_id FROM dw JOIN bw USING (k, win)),
c AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM (SELECT DISTINCT doc_id, i, k FROM h)) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""
