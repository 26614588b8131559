"""Plain versions and small tables for the tests of this folder."""

from __future__ import annotations

import re

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    ]
)

#: names that the operators use themselves
CLASHING = (
    "kept keep_id group_size hash n id node component digest bytes sha start length ids rank slot spans s f x value score label features "
    "covered lines d t fingerprint positions hashes next_text _id topic tokens factor probability copies sequence_id offset a.b _toxicity kept_key text_key"
).split()


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def frame(spark, rows, extra=()):
    """(doc_id, text, ...) rows as documents, with clashing extra columns if asked for."""
    full = [(i, t, *(rest or ("en", "src0")), None if t is None else len(t)) for i, t, *rest in rows]
    df = spark.createDataFrame(full, SCHEMA)
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(7).alias(c) for c in extra])


def shingles(text, width=5):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lower(text)) if w]
    if not words:
        return set()
    if len(words) < width:
        return {tuple(words)}
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def near_components(rows, percent, width=5):
    """{doc_id: smallest id reachable} by comparing all pairs."""
    sets = {i: shingles(t, width) for i, t in rows}
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                r, s = sorted((root(a), root(b)))
                up[s] = r
    return {i: root(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
