import random

import numpy as np

from helpers import CLASHING, frame, near_components
from ticklake.llm import near_dedup
from ticklake.llm.near_dedup import components, drop_near_copies, near_groups, shingle_hashes


def words(rng, n):
    return [f"w{rng.randrange(4000)}" for _ in range(n)]


def edited(rng, base, edits):
    out = list(base)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"x{rng.randrange(10**6)}"
    return out


def table():
    """Groups of near copies around the threshold, a chain, a shared passage, copies and edge cases."""
    rng, rows, i = random.Random(3), [], 10
    for size in (60, 150, 400):
        base = words(rng, size)
        for copy in range(14):
            rows.append((i, " ".join(edited(rng, base, copy % 7))))
            i += 1
    link = words(rng, 200)
    for _ in range(8):  # each is close to the one before only
        link = edited(rng, link, 2)
        rows.append((i, " ".join(link)))
        i += 1
    passage = words(rng, 60)
    for _ in range(25):
        rows.append((i, " ".join(words(rng, 30) + passage + words(rng, 30))))
        i += 1
    rows += [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "ONE\ntwo"), (6, "one"), (7, rows[0][1]), (8, rows[0][1].upper()), (9, "w " * 5000)]
    return rows


def check(got, rows, percent):
    comp, sizes = near_components(rows, percent)
    want = {i: (sizes[i], comp[i], comp[i] == i) for i, _ in rows}
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == want


def test_like_all_pairs(spark):
    rows = table()
    for percent in (80, 85):
        check(near_groups(frame(spark, rows, CLASHING), percent=percent).collect(), rows, percent)


def test_given_documents_like_all_pairs(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    check(near_groups(docs, percent=85).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()], 85)


def test_every_step_finds_its_links(spark):
    """Without families all pairs go by the lists; with loose ones nearly all go by differences."""
    rows = table()
    for family in (2.0, 0.01):
        check(near_groups(frame(spark, rows), percent=80, family=family).collect(), rows, 80)


def test_many_copies_of_one_original(spark):
    """A third of the table: copies at all distances, most of them too far from each other."""
    rng = random.Random(11)
    base = words(rng, 150)
    rows = [(i, " ".join(edited(rng, base, rng.randrange(14)))) for i in range(220)]
    rows += [(1000 + i, " ".join(words(rng, 80))) for i in range(60)]
    for percent in (80, 85):
        check(near_groups(frame(spark, rows), percent=percent).collect(), rows, percent)


def test_null_ids_repeated_rows_and_empty_tables(spark):
    assert near_groups(frame(spark, [])).collect() == []
    text = "a b c d e f g h"
    got = {tuple(r) for r in near_groups(frame(spark, [(None, text), (4, text), (4, text), (6, text)])).collect()}
    assert got == {(None, 4, None, True), (4, 4, 4, True), (6, 4, 4, False)}


def test_dropping_keeps_all_columns(spark):
    docs = frame(spark, [(1, "a b c d e f"), (2, "A b c d e f"), (3, None), (None, "z")], CLASHING)
    left = drop_near_copies(docs)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == {1, 3, None}


def test_components_of_long_chains(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(100, 140)] + [(1, 2), (7, 2), (9, 8)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(links).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, 1: 1, 2: 1, 7: 1, 8: 8, 9: 8}


def test_no_round_that_changes_nothing(spark, monkeypatch):
    labels, cut = [], near_dedup.cut
    monkeypatch.setattr(near_dedup, "cut", lambda df, label: labels.append(label) or cut(df, label))
    links = spark.createDataFrame([(1, 2), (3, 1), (1, 4), (7, 8), (5, 5), (8, 7)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(links).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 7: 7, 8: 7} and labels.count("small-star") == 1
    assert components(links.where("a > 9")).collect() == [] and labels.count("small-star") == 2


def test_shingles_are_position_sensitive():
    a, b = shingle_hashes([b"a", b"b", b"c", b"d", b"e"], 5), shingle_hashes([b"b", b"a", b"c", b"d", b"e"], 5)
    assert len(a) == len(b) == 1 and a[0] != b[0]
    assert shingle_hashes([], 5).dtype == np.int64 and len(shingle_hashes([b"a", b"b"], 5)) == 1


def test_an_id_with_two_texts_loses_the_near_copy_only(spark):
    base = " ".join(f"w{k}" for k in range(200))
    near = base.replace("w100 ", "x ")
    docs = frame(spark, [(3, base), (5, near), (5, "another text of more than five words"), (5, None), (None, base), (7, near), (7, near)], CLASHING)
    left = drop_near_copies(docs)
    assert left.columns == docs.columns
    got = sorted((str(r["doc_id"]), str(r["text"])) for r in left.collect())
    assert got == sorted([("3", base), ("5", "another text of more than five words"), ("5", "None"), ("None", base)])
    assert drop_near_copies(docs.limit(0)).collect() == []
