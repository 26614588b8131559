"""Near-duplicate groups by bottom-k sketches of one hash function.

Words are shingled and every shingle is hashed once to 64 bits.  A document's sketch is its ``K`` smallest
shingle hashes.  Equal word sequences are one node, so copies cost nothing further.

1. Inverted lists.  Two sets with a Jaccard of ``t`` share at least the fraction ``t`` (in expectation) of the
   ``K`` smallest hashes of their union, and whatever lies there is in both sketches.  ``SHARE`` is the part of a
   sketch a pair has to share: with K = 32 and a Jaccard of 0.8 fewer than 11 common values have a probability
   of 3e-9, at 0.85 of 1e-11.  So it is enough to list a node under its ``K - 11 + 1`` values with the
   shortest lists; frequent passages fall out of the lists by themselves, with no cap on a list's length.
2. Families.  Each list compares its members with one leader, the node whose values are the most frequent, by union
   sketches.  A node follows the leader it is closest to, and that leader's own, up to the pivot of a family: the
   node closest to the common original.  This is linear in the lists, however long they are.
3. Exact check against the pivot, on full sets.  Only the difference ``D`` to the pivot is kept.
4. Inside a family, nodes that are in different components after step 3 can only be linked if their differences
   overlap: |x ^ y| = |D_x| + |D_y| - 2 |D_x & D_y|, and one of the two is too far from the pivot by itself.  The
   bound on that overlap gives prefixes of the differences to list and a test by counts alone, so the many copies of
   one original that differ each in their own way are not compared with each other.
5. Pairs of a list that belong to different families and components are filtered by their union sketches
   and checked on full sets.

Every pair that shares a list is covered by step 3, 4 or 5, so no link is lost, and pairs inside a component, which
cannot change the result, are never written out.  Components come from large-star and small-star rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import cut, documents, keep_rows, quoted, text_or_empty

K = 32
SHARE = 0.36
FAMILY = 0.2  # least estimated Jaccard to a leader that a node follows
ROWS = 256  # rows handled at once in a task
SHARDS = 32  # parts of a family where its rows meet what is known of it


def shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; with fewer words the whole sequence is the only one."""
    if not words:
        return np.empty(0, np.int64)
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(width, len(words))
    n = len(words) - width + 1
    mixed = np.full(n, 0x9E3779B97F4A7C15 + width, np.uint64)
    for i in range(width):
        mixed ^= one[i : i + n]
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0x94D049BB133111EB)
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed.view(np.int64))


def _arrays(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts) if parts else np.empty(0, np.int64), pa.int64()))


def _sketcher(width: int, k: int, whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                ids, digests, sizes, sketches = part.column(0), [], [], []
                for text in part.column(1):
                    words = text.as_py().encode().lower().split()  # A-Z only; splits at space and 09-0D
                    hashes = shingle_hashes(words, width)
                    digests.append(xxhash.xxh3_128_digest(b" ".join(words)))
                    sizes.append(len(hashes))
                    sketches.append(hashes if whole else hashes[:k])
                yield pa.RecordBatch.from_arrays(
                    [ids, part.column(2), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), _arrays(sketches)], names=["id", "text_key", "digest", "n", "hashes"]
                )

    return run


def sketches(docs: DataFrame, id_col: str, text_col: str, width: int = 5, k: int = K, whole: bool = False) -> DataFrame:
    """(id, text_key: md5 of the text, digest of the word sequence, n distinct shingles, hashes: the ``k`` smallest or
    all, ascending)."""
    text = text_or_empty(text_col)
    return docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.md5(text.cast("binary")).alias("text_key")).mapInArrow(
        _sketcher(width, k, whole), "id long, text_key string, digest binary, n long, hashes array<long>"
    )


def inverted_lists(nodes: DataFrame, k: int, share: float) -> DataFrame:
    """(v, node, n, weight): each node under its values with the shortest lists; lists of one are left out."""
    entries = nodes.select("node", "n", F.explode("hashes").alias("v"))
    shared = entries.join(entries.groupBy("v").agg(F.count("*").alias("f")).where("f > 1"), "v")
    held = F.least(F.lit(k), F.col("n"))
    needed = F.greatest(F.lit(1), F.floor(F.lit(share) * held))
    listed = (
        shared.groupBy("node", "n")
        .agg(F.sort_array(F.collect_list(F.struct("f", "v"))).alias("by_length"), F.sum("f").alias("weight"))
        # values that nobody else holds are the rarest: they come first and need no entry
        .withColumn("take", (held - needed + 1) - (held - F.size("by_length")))
        .where("take > 0")
    )
    return listed.select("node", "n", "weight", F.explode(F.expr("slice(by_length, 1, cast(take as int))")).alias("e")).select(
        F.col("e.v").alias("v"), "node", "n", "weight"
    )


def estimates(pairs: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """``pairs`` (a, b) with n_a, n_b, ``width`` of the union sketch and ``common``, how much of it both hold."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("hashes").alias(f"h_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    both = both.withColumn("union_sketch", F.slice(F.array_sort(F.array_union("h_a", "h_b")), 1, k))
    common = F.size(F.array_intersect(F.array_intersect("h_a", "h_b"), F.col("union_sketch")))
    return both.select("a", "b", "n_a", "n_b", F.size("union_sketch").alias("width"), common.alias("common"))


def estimated_close(pairs: DataFrame, nodes: DataFrame, k: int, share: float) -> DataFrame:
    """Pairs whose union sketch allows the similarity."""
    return estimates(pairs, nodes, k).where(F.col("common") >= F.floor(F.lit(share) * F.col("width"))).select("a", "b", "n_a", "n_b")


def full_sets(wanted: DataFrame, docs: DataFrame, id_col: str, text_col: str, nodes: DataFrame, width: int) -> DataFrame:
    """(node, n, hashes) with all hashes of the wanted nodes."""
    texts = docs.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).alias("text")).join(wanted.select("node").distinct(), "node", "left_semi")
    sets = sketches(texts, "node", "text", width, whole=True).join(nodes.select(F.col("node").alias("id"), "digest"), ["id", "digest"])
    return cut(sets.select(F.col("id").alias("node"), "n", "hashes").dropDuplicates(["node"]), "near-sets")


def linked(n_a: Column | str, n_b: Column | str, common: Column | str, percent: int) -> Column:
    n_a, n_b, common = (F.col(x) if isinstance(x, str) else x for x in (n_a, n_b, common))
    return 100 * common >= percent * (n_a + n_b - common)


def sizes_allow(n_a: Column, n_b: Column, percent: int) -> Column:
    return 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)


def exact_links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs that reach the similarity on their full shingle sets."""
    side = lambda x: sets.select(F.col("node").alias(x), F.col("hashes").alias(f"s_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    both = both.select("a", "b", "n_a", "n_b", F.size(F.array_intersect("s_a", "s_b")).alias("c"))
    return both.where(linked("n_a", "n_b", "c", percent)).select("a", "b")


def families(lists: DataFrame, nodes: DataFrame, k: int, least: float) -> DataFrame:
    """(node, pivot): the pivot each node is compared with; nodes that lead themselves are their own pivot.

    A leader outranks the other members of its list by (weight, smaller id), so following leaders ends.
    """
    top = F.max(F.struct("weight", F.negative("node").alias("negative")))
    lead = lists.groupBy("v").agg(F.count("*").alias("m"), top.alias("top")).where("m > 1").select("v", F.negative("top.negative").alias("a"))
    stars = lists.select("v", F.col("node").alias("b")).join(lead, "v").where("a <> b").select("a", "b").distinct()
    close = estimates(stars, nodes, k).where(F.col("common") >= F.lit(least) * F.col("width"))
    best = F.max(F.struct((F.col("common") / F.col("width")).alias("near"), F.negative("a").alias("negative")))
    follows = cut(close.groupBy(F.col("b").alias("node")).agg(best.alias("best")).select("node", F.negative("best.negative").alias("parent")), "near-parents")
    tops = follows.select("node", F.col("parent").alias("top"))
    while True:
        up = tops.select(F.col("node").alias("top"), F.col("top").alias("higher"))
        tops = cut(tops.join(up, "top", "left").select("node", F.coalesce("higher", "top").alias("top"), F.col("higher").isNotNull().alias("moved")), "near-tops")
        if tops.where("moved").isEmpty():
            break
        tops = tops.select("node", "top")
    far = estimates(tops.select(F.col("top").alias("a"), F.col("node").alias("b")), nodes, k)
    near_top = far.where(F.col("common") >= F.lit(least) * F.col("width")).select(F.col("b").alias("node"), F.col("a").alias("top"))
    pivots = follows.join(near_top, "node", "left").select("node", F.coalesce("top", "parent").alias("pivot"))
    leading = pivots.select(F.col("pivot").alias("node")).distinct().join(follows.select("node"), "node", "left_anti")
    return pivots.unionByName(leading.select("node", F.col("node").alias("pivot")))


def differences(pivots: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, pivot, n, pivot_n, d): elements that only one of the node and its pivot has."""
    mine = sets.select("node", "n", F.col("hashes").alias("own"))
    theirs = sets.select(F.col("node").alias("pivot"), F.col("n").alias("pivot_n"), F.col("hashes").alias("other"))
    both = pivots.join(mine, "node").join(theirs, "pivot")
    return both.select("node", "pivot", "n", "pivot_n", F.concat(F.array_except("own", "other"), F.array_except("other", "own")).alias("d"))


def family_pairs(diffs: DataFrame, of_node: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of a family in different components whose differences may overlap enough for a link."""
    t = percent / 100
    c = (1 - t) / (1 + t)  # linked: |x ^ y| <= c (|x| + |y|)
    rows = diffs.join(of_node, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = rows.groupBy("pivot").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("pivot")
    # a family may hold a third of all rows: its rows meet ``SHARDS`` copies of its one row, never by broadcast, as the
    # copies are small where they are shuffled and large where they are kept
    mixed = mixed.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(SHARDS - 1))))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("node"), F.lit(SHARDS)).cast("int")).where(F.size("d") > 0)
    rows = rows.join(mixed.hint("merge"), ["pivot", "shard"], "left_semi").drop("shard")
    each = rows.select("pivot", "node", "n", "component", F.size("d").alias("dn"), F.explode("d").alias("e"))
    shared = each.join(each.groupBy("pivot", "e").agg(F.count("*").alias("f")).where("f > 1"), ["pivot", "e"])
    # least overlap with any partner; elements that no one else has come first in the order by frequency
    least = F.greatest(F.lit(1), F.ceil(F.col("dn") - c * (F.col("n") + F.floor(F.col("n") / t)) - 1e-6))
    listed = (
        shared.groupBy("pivot", "node", "n", "component", "dn").agg(F.sort_array(F.collect_list(F.struct("f", "e"))).alias("by_length"))
        .withColumn("s", F.size("by_length")).withColumn("take", F.col("s") - least + 1).where("take > 0")
        .select("pivot", "node", "n", "component", "dn", "s", F.explode(F.expr("slice(by_length, 1, cast(take as int))")).alias("x"))
        .select("pivot", F.col("x.e").alias("e"), F.struct("node", "n", "component", "dn", "s").alias("m"))
    )
    listed = cut(listed, "near-listed")  # read by both sides of the join
    x, y = F.col("x"), F.col("y")
    needed = (x["dn"] + y["dn"] - c * (x["n"] + y["n"])) / 2
    may = (x["node"] < y["node"]) & (x["component"] != y["component"]) & sizes_allow(x["n"], y["n"], percent) & (needed <= F.least(x["s"], y["s"]) + 1e-6)
    left, right = listed.withColumnRenamed("m", "x"), listed.withColumnRenamed("m", "y")
    joined = left.join(right, (left["pivot"] == right["pivot"]) & (left["e"] == right["e"]) & may)
    return joined.select(x["node"].alias("a"), y["node"].alias("b")).distinct()


def family_links(pairs: DataFrame, diffs: DataFrame, percent: int) -> DataFrame:
    """Pairs of a family that reach the similarity, counted on their differences."""
    side = lambda x: diffs.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("d").alias(f"d_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    apart = F.size("d_a") + F.size("d_b") - 2 * F.size(F.array_intersect("d_a", "d_b"))
    common = (F.col("n_a") + F.col("n_b") - apart) / 2
    return both.where(linked("n_a", "n_b", common, percent)).select("a", "b")


def other_pairs(lists: DataFrame, pivots: DataFrame, of_node: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of a list in different components and families that were not compared yet."""
    rows = lists.join(of_node, "node", "left").withColumn("component", F.coalesce("component", "node")).join(pivots, "node", "left")
    mixed = rows.groupBy("v").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("v")
    rows = rows.join(mixed, "v", "left_semi").select("v", F.struct("node", "n", "component", "pivot").alias("m"))
    x, y = F.col("x"), F.col("y")
    same = F.coalesce(x["pivot"] == y["pivot"], F.lit(False)) | F.coalesce(x["pivot"] == y["node"], F.lit(False)) | F.coalesce(y["pivot"] == x["node"], F.lit(False))
    may = (x["node"] < y["node"]) & (x["component"] != y["component"]) & sizes_allow(x["n"], y["n"], percent) & ~same
    left, right = rows.withColumnRenamed("m", "x"), rows.withColumnRenamed("m", "y")
    return left.join(right, (left["v"] == right["v"]) & may).select(x["node"].alias("a"), y["node"].alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component: smallest node reachable) for every node of a link, in logarithmically many rounds.

    The rounds end as soon as every node is either a smallest one or linked with one only: another round would change
    nothing then, and each costs the driver the plans, jobs and stages of five shuffles.
    """
    edges = cut(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "links")
    while True:
        # large star: larger neighbours of a node move to the smallest of its neighbourhood
        both = edges.union(edges.select("b", "a").toDF("a", "b"))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(least, "a").where("b > a").select(F.col("low").alias("a"), "b").where("a < b").distinct()
        large = cut(large, "large-star")
        # small star: a node and its smaller neighbours move to the smallest of them
        lower = large.select(F.col("b").alias("u"), F.col("a").alias("w"))
        low = lower.groupBy("u").agg(F.min("w").alias("low"))
        moved = lower.join(low, "u").where("w > low").select(F.col("low").alias("a"), F.col("w").alias("b"))
        edges = cut(moved.union(low.select(F.col("low").alias("a"), F.col("u").alias("b"))).distinct(), "small-star")
        ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("low"), F.lit(0).alias("high")).union(edges.select("b", F.lit(0), F.lit(1)))
        if ends.groupBy("node").agg(F.max("low").alias("low"), F.sum("high").alias("high")).where("low + high > 1").isEmpty():
            break
    return edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component")).union(edges.select("a", F.col("a")).distinct())


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``keyed_groups``, with the same options, without ``text_key``."""
    return keyed_groups(docs, id_col, text_col, **options).drop("text_key")


def keyed_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, k: int = K, share: float = SHARE, family: float = FAMILY
) -> DataFrame:
    """One row per input row: ``id_col``, ``n_shingles``, ``component_id`` (smallest id reachable), ``kept``, and
    ``text_key``, the md5 of the text.

    Documents are linked when the Jaccard of their sets of ``width``-word shingles is at least ``percent`` / 100.
    A-Z are lower-cased; words are separated by space and 09-0D.  With fewer words the whole sequence is the only
    shingle.  Null texts and texts without words have no shingles and are linked with nothing.  Rows with the
    same id are the same document.  Rows with a null id are not linked: ``component_id`` is null and they stay.
    An empty table gives an empty result; further columns of ``docs`` are not read.
    """
    rows = cut(sketches(docs, id_col, text_col, width, k), "near-sketches")
    alive = rows.where("n > 0 and id is not null")
    copies = alive.groupBy("digest").agg(F.min("id").alias("node"))
    nodes = copies.join(alive, (copies["digest"] == alive["digest"]) & (F.col("node") == F.col("id")))
    nodes = cut(nodes.select("node", copies["digest"], "n", "hashes").dropDuplicates(["node", "digest"]), "near-nodes")
    lists = cut(inverted_lists(nodes, k, share), "near-lists")

    pivots = cut(families(lists, nodes, k, family), "near-pivots")
    sets = full_sets(pivots, docs, id_col, text_col, nodes, width)
    diffs = cut(differences(pivots, sets), "near-differences")
    common = (F.col("n") + F.col("pivot_n") - F.size("d")) / 2
    links = cut(diffs.where((F.col("node") != F.col("pivot")) & linked("n", "pivot_n", common, percent)).select(F.col("node").alias("a"), F.col("pivot").alias("b")), "near-links")
    of_node = cut(components(links), "near-components")

    inside = cut(family_links(family_pairs(diffs, of_node, percent), diffs, percent), "near-links")
    others = cut(estimated_close(other_pairs(lists, pivots, of_node, percent), nodes, k, share), "near-close")
    if not others.isEmpty():
        wanted = others.select(F.explode(F.array("a", "b")).alias("node"))
        inside = inside.union(cut(exact_links(others, full_sets(wanted, docs, id_col, text_col, nodes, width), percent), "near-links"))
    if not inside.isEmpty():
        of_node = cut(components(of_node.select("component", "node").toDF("a", "b").union(inside)), "near-components")

    groups = copies.join(of_node, "node", "left").select(F.col("digest").alias("d"), F.coalesce("component", "node").alias("component"))
    out = rows.join(groups, (F.col("digest") == F.col("d")) & F.col("id").isNotNull(), "left")
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"),
        "text_key",
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """Rows of ``docs`` without near copies: the smallest id of each group stays, all columns as they are.

    A row is known by its id and text: a near copy of another id's text goes, even where its id stays with another
    text.  Rows without words and rows with a null id stay; repeated rows stay or go together; an empty table stays
    empty, and names of further columns do not matter.
    """
    key = F.md5(F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit("")).cast("binary"))
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("id"), F.col(quoted(text_col)).alias("text"), key.alias("text_key"))
    of_id = rows.where("id is not null").groupBy("id").agg(F.min("text_key").alias("lo"), F.max("text_key").alias("hi"))
    if of_id.where("lo < hi").isEmpty():
        kept = keyed_groups(rows, "id", "text", percent=percent).where("kept").select("id", "text_key")
    else:
        # ids that stand on several texts: (id, text) pairs are numbered in the order of the ids, smaller id, smaller number
        pairs = rows.where("id is not null").select("id", "text_key").distinct().orderBy("id", "text_key")
        pairs = cut(pairs.withColumn("number", F.monotonically_increasing_id()), "near-numbers")
        own = pairs.select(F.col("id").alias("pair_id"), F.col("text_key").alias("pair_key"), "number")
        numbered = rows.join(own, (F.col("id") == F.col("pair_id")) & (F.col("text_key") == F.col("pair_key")), "left").select("number", "text")
        stays = keyed_groups(numbered, "number", "text", percent=percent).where("kept and number is not null").select("number").distinct()
        nameless = rows.where("id is null").select("id", "text_key")
        kept = pairs.join(stays, "number", "left_semi").select("id", "text_key").unionByName(nameless)
    return keep_rows(docs, kept, id_col, key)


def op6_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_groups(documents(spark, sf_dir), percent=85)
