import hashlib
import random
import re
import struct
from collections import defaultdict

import xxhash

from helpers import CLASHING, frame, plan
from ticklake.llm.common import cut as winnowing_cut
from ticklake.llm.winnowing import GRAM, POSITION_BITS, RUN, WINDOW, fingerprints, op10_winnowing


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def brute(text):
    """(positions, hashes) by scanning every window."""
    tokens = re.findall(f"[^ \t\n\r\x0b\f]{{1,{RUN}}}", text or "")
    h = [signed(xxhash.xxh64_intdigest(t.encode(), seed=42)) for t in tokens]
    grams = []
    for i in range(max(len(h) - GRAM + 1, min(len(h), 1))):
        seed = 42
        for x in h[i : i + GRAM]:
            seed = xxhash.xxh64_intdigest(struct.pack("<q", x), seed=seed)
        grams.append(signed(seed))
    at = []
    for i in range(max(len(grams) - WINDOW + 1, min(len(grams), 1))):
        window = range(i, min(i + WINDOW, len(grams)))
        best = min(window, key=lambda k: (grams[k] >> POSITION_BITS, -k))
        if best not in at:
            at.append(best)
    return at, [grams[k] for k in at]


def test_like_a_scan_of_every_window(spark):
    rng = random.Random(2)
    texts = [None, "", " \n", "one", "a b c", "same " * 50, "x" * 500, "é😀 ß\tz " * 9, *[" ".join(f"w{rng.randrange(30)}" for _ in range(rng.randrange(120))) for _ in range(40)], "long words " * 20_000]
    for r in fingerprints(frame(spark, list(enumerate(texts)), CLASHING)).collect():
        want = brute(texts[r["doc_id"]])
        assert (r["fingerprint"]["positions"], r["fingerprint"]["hashes"]) == want, r["doc_id"]
        assert r["n_chars"] == len(texts[r["doc_id"]] or "")


def test_shared_passages_share_a_gram(spark):
    rng = random.Random(4)
    for _ in range(5):
        passage = [f"p{rng.randrange(1000)}" for _ in range(GRAM + WINDOW - 1)]
        rows = [(i, " ".join([f"a{rng.randrange(1000)}" for _ in range(rng.randrange(50))] + passage + [f"b{rng.randrange(1000)}" for _ in range(50)])) for i in range(4)]
        sets = [set(r["fingerprint"]["hashes"]) for r in fingerprints(frame(spark, rows)).collect()]
        assert all(a & b for a in sets for b in sets)


def test_op10_on_given_documents(spark, sf):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = op10_winnowing(spark, sf)
    got = {r["doc_id"]: r for r in out.collect()}
    assert "Python" not in plan(out) and "Arrow" not in plan(out)
    order = sorted(texts, reverse=True)
    jaccard = lambda a, b: len(set(a) & set(b)) / len(set(a) | set(b)) if a or b else 1.0
    written = lambda f: ",".join(f"{h % (1 << 64):x}@{p}" for p, h in zip(*f, strict=True))
    for k, i in enumerate(order):
        text, after = texts[i], texts[order[(k + 1) % len(order)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b, c = brute(text), brute(edited), brute(after)
        r = got[i]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"].lower() == written(a) and r["edited_fingerprint"].lower() == written(b)
        assert abs(r["near_edited"] - jaccard(a[1], b[1])) < 1e-12 and abs(r["near_next"] - jaccard(a[1], c[1])) < 1e-12


def test_next_rows_over_ranges(spark, monkeypatch, tmp_path):
    from ticklake.llm import winnowing

    monkeypatch.setattr(winnowing, "RANGE_ROWS", 3)
    ids = [0, 1, 2, 50, 51, 52, 53, 54, 400, 1000, 1001]
    rows = frame(spark, [(i, f"t{i}") for i in ids]).select("doc_id", "text")
    got = {r["doc_id"]: r["next_text"] for r in winnowing.with_next(rows, "doc_id", ["text"], ["text"]).collect()}
    down = sorted(ids, reverse=True)
    assert got == {i: f"t{down[(k + 1) % len(down)]}" for k, i in enumerate(down)}
    odd = frame(spark, [(None, "n"), (4, "b"), (4, "a"), (9, "z")]).select("doc_id", "text")
    got = {(r["text"], r["next_text"]) for r in winnowing.with_next(odd, "doc_id", ["text"], ["text"]).collect()}
    assert got == {("z", "a"), ("a", "b"), ("b", "n"), ("n", "z")}
    assert winnowing.with_next(frame(spark, []).select("doc_id", "text"), "doc_id", ["text"], ["text"]).collect() == []


def test_ranges_are_cut_by_rank(spark, monkeypatch):
    from ticklake.llm import winnowing

    monkeypatch.setattr(winnowing, "RANGE_ROWS", 50)
    made = {}
    monkeypatch.setattr(winnowing, "cut", lambda df, label: made.setdefault(label, winnowing_cut(df, label)))
    rng = random.Random(1)
    lone = [(i, f"t{rng.random()}") for i in [*range(1000), 10**12, -(10**15), (1 << 63) - 1, -(1 << 63)]]
    rows = [*lone, *[(None, f"n{rng.random()}") for _ in range(500)], *[(7000, "same") for _ in range(500)]]
    got = winnowing.with_next(frame(spark, rows).select("doc_id", "text"), "doc_id", ["text"], ["text"]).collect()
    sizes = [r["count"] for r in made["ranges"].groupBy("_range").count().collect()]
    assert sum(sizes) == len(rows) == len(got) and max(sizes) <= 100 and len(sizes) == 41
    # one cycle through all rows by descending id, null ids last
    ids = {t: i for i, t in rows}
    after = defaultdict(list)
    for r in got:
        after[r["text"]].append(r["next_text"])
    down = [t for i, t in sorted(lone, reverse=True)]
    down.insert([ids[t] for t in down].index(999), "same")
    assert sorted(after["same"]) == sorted(["same"] * 499 + [down[down.index("same") + 1]])
    assert all(after[a] == [b] for a, b in zip(down, down[1:]) if a != "same")
    at, seen = after[down[-1]][0], set()
    while ids[at] is None:
        seen.add(at)
        (at,) = after[at]
    assert len(seen) == 500 and at == down[0]


def test_passages_without_blanks_share_a_gram_at_any_offset(spark):
    rng = random.Random(5)
    for first, last in ((0x4E00, 0x9FA5), (0x3041, 0x3096), (0x0E01, 0x0E2E)):
        run = lambda n: "".join(chr(rng.randint(first, last)) for _ in range(n))  # noqa: E731, B023
        passage = run(GRAM + WINDOW - 1)
        rows = [(i, run(i) + passage + run(50)) for i in range(0, 30, 5)]
        sets = [set(r["fingerprint"]["hashes"]) for r in fingerprints(frame(spark, rows)).collect()]
        assert all(a & b for a in sets for b in sets)
