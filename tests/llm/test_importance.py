import hashlib
import math
import random
import re
import zlib
from collections import Counter

from helpers import CLASHING, frame, lower
from ticklake.llm import importance as module
from ticklake.llm.importance import bucket_counts, importance, resampled

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def runs(text, run):
    w = re.findall(WORD, lower(text))
    return [" ".join(w[i : i + k]) for k in range(1, run + 1) for i in range(len(w) - k + 1)]


def bucket(x, buckets):
    return zlib.crc32(x.encode()) % buckets


def brute(docs, target, run=1, buckets=10_000, min_words=20, percent=10):
    """[(id, n_features, weight, score, rank)] in the order of the rows."""
    s = Counter(bucket(f, buckets) for _, t in docs for f in runs(t, run))
    t = Counter(bucket(f, buckets) for _, x in target for f in runs(x, run))
    big_s, big_t = s.total(), t.total()
    gain = [math.floor(1000 * math.log(((t[b] + 1.0) * (big_t * 0 + big_s + buckets)) / ((s[b] + 1.0) * (big_t + buckets)))) for b in range(buckets)]
    rows = []
    for i, text in docs:
        found = [gain[bucket(f, buckets)] for f in runs(text, run)]
        weight = sum(found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    large = [k for k, (_, x) in enumerate(docs) if len(runs(x, 1)) >= min_words]
    order = sorted(large, key=lambda k: (-rows[k][3], rows[k][0] is None, rows[k][0] or 0, rows[k][1]))
    rank = {k: n + 1 for n, k in enumerate(order[: len(large) * percent // 100])}
    return [(*r, rank.get(k)) for k, r in enumerate(rows)]


def target(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


RNG = random.Random(8)
TEXTS = [" ".join(RNG.choice(["Ab", "cd", "eé", "f7", "ÉG", "hi", "jk", "lm"]) for _ in range(RNG.randrange(60))) for _ in range(120)]
DOCS = [*enumerate(TEXTS), (500, None), (501, ""), (502, " ,;"), (503, "\x00a b\x00"), (504, "x" * 50_000), (505, "ab, cd. " * 60_000)]
TARGET = [(1, "ab ab cd lm"), (2, None), (3, "f7 f7 zz")]


def got(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect())


def key(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))


def test_like_plain_counts(spark):
    out = importance(frame(spark, DOCS, (*CLASHING, "a.b", "weight", "n_words", "rank", "doc")), target(spark, TARGET))
    assert got(out) == key(brute(DOCS, TARGET))


def test_longer_runs_and_other_parameters(spark, monkeypatch):
    monkeypatch.setattr(module, "SLICE_BYTES", 300)
    docs = DOCS[:124]
    for run in (2, 3):
        out = importance(frame(spark, docs), target(spark, TARGET), run=run, buckets=97, min_words=5, percent=37)
        assert got(out) == key(brute(docs, TARGET, run, 97, 5, 37))


def test_null_ids_ties_and_repeated_rows(spark):
    docs = [(None, TEXTS[k]) for k in range(30)] + [(7, TEXTS[3]), (7, TEXTS[3]), (7, TEXTS[5]), (8, None), (8, None)]
    want = brute(docs, TARGET, min_words=1, percent=50)
    rows = [tuple(r) for r in importance(frame(spark, docs), target(spark, TARGET), min_words=1, percent=50).select("doc_id", "n_features", "weight", "score", "rank").collect()]
    assert Counter(r[:4] for r in rows) == Counter(r[:4] for r in want)
    ranks = lambda x: {(r[0], r[3], r[4]) for r in x if r[4]}
    assert ranks(rows) == ranks(want)


def test_empty_tables(spark):
    assert importance(frame(spark, []), target(spark, TARGET)).collect() == []
    assert got(importance(frame(spark, DOCS[:40]), target(spark, []))) == key(brute(DOCS[:40], []))
    assert bucket_counts(frame(spark, [])).collect() == []


def test_ranks_over_many_partitions(spark):
    """A third of all rows share one key; the sort is cut by a number as well."""
    docs = [(None if k % 3 == 0 else k, "ab cd " * 12) for k in range(3000)]
    out = importance(frame(spark, docs).repartition(20), target(spark, TARGET), percent=100)
    assert sorted(r["rank"] for r in out.collect()) == list(range(1, 3001))


def test_drawn_rows_keep_their_columns(spark):
    docs = frame(spark, DOCS, ("a.b", "score", "doc", "_text"))
    out = resampled(docs, target(spark, TARGET), percent=20)
    assert out.columns == docs.columns
    want = {r[0] for r in brute(DOCS, TARGET, percent=20) if r[4]}
    texts = dict(DOCS)
    rows = out.collect()
    assert {r["doc_id"] for r in rows} == want and all(r["text"] == texts[r["doc_id"]] and r["doc"] == 7 for r in rows)
