import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from helpers import CLASHING, frame, lower
from ticklake.llm.spelling_variants import near_words, roots, spelling_variants, word_counts


def counted(docs, min_length=5, min_count=3):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", lower(text)):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= min_length:
                n[run] += 1
    return {w: k for w, k in n.items() if k >= min_count}


def near(a, b):
    """Exactly one inserted, deleted or replaced code point, by trying them all."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(n):
    out = {}
    for w in n:
        others = [x for x in n if x != w and near(w, x)]
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form = best if best is not None and n[best] >= 2 * n[w] else None
        out[w] = [n[w], len(others), form, n[form] if form else None]
    for w, r in out.items():
        root = w
        while out[root][2]:
            root = out[root][2]
        r.append(root)
    return {w: tuple(r) for w, r in out.items()}


def got(df):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in df.collect()}


RNG = random.Random(5)
BASE = ["house", "mouse", "étude", "streets", "abcabc", "aaaaa", "wörter", "ÿÿÿÿÿ", "internationally"]


def slipped(word):
    k, letter = RNG.randrange(len(word)), RNG.choice("abeé")
    return RNG.choice([word[:k] + word[k + 1 :], word[:k] + letter + word[k:], word[:k] + letter + word[k + 1 :], word])


DOCS = [(k, " ".join(slipped(slipped(RNG.choice(BASE))) for _ in range(60)) + "\nHouse,mouse-MOUSE x×y÷ÀÉ") for k in range(80)]
DOCS += [(900, None), (901, ""), (None, "house " * 40), (3, DOCS[3][1]), (902, "z" * 30_000 + " " + "house " * 5000)]


def test_like_all_pairs(spark):
    want = brute(counted(DOCS))
    assert sum(r[1] > 0 for r in want.values()) > 100 and any(r[4] != r[2] for r in want.values() if r[2])
    df = frame(spark, DOCS, (*CLASHING, "a.b", "word", "form", "root", "best"))
    assert got(spelling_variants(df)) == want


@pytest.mark.parametrize(("segments", "tile"), [(1, 7), (2, 3), (4, 1000)])
def test_blocks_and_tiles_do_not_matter(spark, segments, tile):
    assert got(spelling_variants(frame(spark, DOCS), segments=segments, tile=tile)) == brute(counted(DOCS))


def test_short_words_and_other_alphabets(spark):
    rng = random.Random(6)
    words = {"".join(rng.choice("ab😀:中") for _ in range(rng.randrange(1, 6))) for _ in range(300)}
    n = {w: rng.randrange(1, 50) for w in words}
    rows = near_words(spark.createDataFrame(list(n.items()), "word string, n long"), tile=20).collect()
    want = {w: (sum(near(w, x) for x in n if x != w), min((-n[x], x) for x in n if x != w and near(w, x))) for w in n if any(near(w, x) for x in n if x != w)}
    assert {r["word"]: (r["n_near"], (-r["best_n"], r["best"])) for r in rows} == want


def test_a_hot_block_is_dealt_in_tiles(spark):
    words = [("same" + "".join(x) + "tail", 1 + k) for k, x in enumerate((a, b) for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz")]
    rows = {r["word"]: r for r in near_words(spark.createDataFrame(words, "word string, n long"), tile=64).collect()}
    assert len(rows) == 676 and all(r["n_near"] == 50 for r in rows.values())
    assert rows["sameaatail"]["best"] == "sameaztail" or rows["sameaatail"]["best"] == "samezatail"


def test_long_chains(spark):
    forms = spark.createDataFrame([(f"w{k:03d}", f"w{k + 1:03d}") for k in range(100)], "word string, form string")
    assert {r["root"] for r in roots(forms).collect()} == {"w100"}


def test_empty_tables(spark):
    assert spelling_variants(frame(spark, [])).collect() == []
    assert spelling_variants(frame(spark, [(1, None), (2, "some words")])).collect() == []
    one = spelling_variants(frame(spark, [(1, "lonely lonely lonely")])).collect()
    assert [tuple(r) for r in one] == [("lonely", 3, 0, None, None, "lonely")]


def test_counts_cover_every_occurrence(spark):
    rows = word_counts(frame(spark, DOCS).where(F.lit(True)))
    assert {r["word"]: r["n"] for r in rows.collect()} == counted(DOCS)
