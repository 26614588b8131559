import random
import re

import pytest
from pyspark.sql import functions as F

from helpers import CLASHING, frame, lower, plan
from ticklake.llm import decontamination
from ticklake.llm.decontamination import contamination, decontaminated, op11_decontamination

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    return re.findall(WORD, lower(text))


def brute(docs, items, window=10):
    """[(id, n_words, hit positions, items)] by comparing every window with every item's."""
    known = {}
    for item, text in items:
        w = words(text)
        n = min(len(w), window)
        for i in range(len(w) - n + 1 if w else 0):
            known.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in known}:
            for a in range(len(w) - n + 1):
                if tuple(w[a : a + n]) in known:
                    hit |= set(range(a, a + n))
                    found |= known[tuple(w[a : a + n])]
        out.append((i, len(w), hit, sorted(str(x) for x in found if x is not None)))
    return out


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


RNG = random.Random(3)
RUNS = [" ".join(RNG.choice("aa Bb cc Éé dd ff gg 7h".split()) for _ in range(n)) for n in (10, 11, 14, 30, 200, 9)]
ITEMS = [(1, RUNS[0]), (2, RUNS[1]), (20, RUNS[2]), (3, RUNS[3]), (4, "short, item"), (5, None), (6, " ,. "), (7, RUNS[0]), (None, RUNS[5]), (8, "one"), (2, RUNS[4])]
DOCS = [
    (1, RUNS[0]), (2, f"x {RUNS[1].upper()}! y {RUNS[0]}"), (3, RUNS[3][:60]), (4, "a short,\nitem. and short ITEM"), (5, None), (6, ""), (7, "..."), (8, "ones one"), (9, RUNS[4] + RUNS[4]),
    (10, "É" + RUNS[2]), (11, RUNS[5]), (12, " ".join(RNG.choice(["aa", "bb", "short", "item"]) for _ in range(30_000))), (None, RUNS[0]), (None, None), (2, "clean"), (1, RUNS[0]),
]


def got(df):
    key = lambda x: (x[0] is None, x[0] or 0, x[1], x[2])
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items"], r["contaminated"]) for r in df.collect()), key=key)


def want(docs, items, window=10):
    key = lambda x: (x[0] is None, x[0] or 0, x[1], x[2])
    return sorted(((i, n, len(h), len(x), x, bool(h)) for i, n, h, x in brute(docs, items, window)), key=key)


def test_like_a_scan_of_all_windows(spark):
    out = contamination(frame(spark, DOCS, (*CLASHING, "a.b", "wid", "at", "rid")), bench(spark, ITEMS))
    assert got(out) == want(DOCS, ITEMS)


def test_several_broadcasts_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "SET_WINDOWS", 40)
    assert got(contamination(frame(spark, DOCS), bench(spark, ITEMS))) == want(DOCS, ITEMS)


def test_other_window(spark):
    assert got(contamination(frame(spark, DOCS[:11]), bench(spark, ITEMS), window=4)) == want(DOCS[:11], ITEMS, 4)


def test_empty_tables(spark):
    assert contamination(frame(spark, []), bench(spark, ITEMS)).collect() == []
    assert [(r["n_words"], r["contaminated"]) for r in contamination(frame(spark, DOCS[:1]), bench(spark, [])).collect()] == [(10, False)]
    assert contamination(frame(spark, DOCS), bench(spark, [(1, None), (2, "...")])).where("contaminated").count() == 0


def test_spans_and_documents_go(spark):
    docs = frame(spark, DOCS, ("a.b", "kept", "text_key", "contaminated", "spans", "Own", "_own", "between", "found_id"))
    hit = {(i, t) for (i, t), (_, _, h, _) in zip(DOCS, brute(DOCS, ITEMS), strict=True) if h}
    left = decontaminated(docs, bench(spark, ITEMS), remove="documents")
    assert left.columns == docs.columns
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in left.collect()) == sorted((str(i), str(t)) for i, t in DOCS if (i, t) not in hit)
    cleaned = decontaminated(docs, bench(spark, ITEMS))
    assert cleaned.columns == docs.columns
    expected = []
    for (i, t), (_, _, h, _) in zip(DOCS, brute(DOCS, ITEMS), strict=True):
        if not h:
            expected.append((str(i), str(t)))
            continue
        between = re.split(decontamination.RAW_WORD, t)
        own = re.findall(decontamination.RAW_WORD, t)
        expected.append((str(i), between[0] + "".join(w + between[k + 1] for k, w in enumerate(own) if k not in h)))
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in cleaned.collect()) == sorted(expected)
    with pytest.raises(ValueError, match="remove"):
        decontaminated(docs, docs, remove="rows")


def test_op11_on_given_documents(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    out = op11_decontamination(spark, sf)
    assert "Python" not in plan(out) and "Arrow" not in plan(out)
    rows = {r["doc_id"]: r for r in out.collect()}
    known = brute(docs, items)
    assert any(h for _, _, h, _ in known)
    for i, n, h, x in known:
        assert (rows[i]["n_words"], rows[i]["n_hit"], rows[i]["n_items"], rows[i]["contaminated"]) == (n, len(h), len(x), bool(h))


def test_documents_are_looked_up_where_they_are_read(spark, sf, monkeypatch):
    """No shuffle between the scan and the look-up, with size checks for broadcasts off."""
    seen = {}
    real = decontamination.cut
    monkeypatch.setattr(decontamination, "cut", lambda df, label: real(seen.setdefault(label, df), label))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        contamination(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet"))
        text = plan(seen["hits"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in text and text.count("Exchange hashpartitioning") == 1


def test_item_ids_are_listed_as_texts(spark):
    out = contamination(frame(spark, [(1, "q w e")]), bench(spark, [(10, "q w"), (9, "w e"), (100, "q")])).first()
    assert out["items"] == ["10", "100", "9"] and out["spans"][0].asDict() == {"start": 0, "end": 3}
    assert contamination(frame(spark, [(1, "q w e")]), bench(spark, [(1, "w")])).select(F.col("spans")[0]["start"]).first()[0] == 1
