import hashlib
from collections import defaultdict

import pytest

from helpers import CLASHING, frame, lower
from ticklake.llm.exact_dedup import drop_exact_copies, exact_groups

ROWS = [(1, "Same Text"), (5, "same text"), (3, "SAME TEXT"), (9, "other"), (2, None), (4, ""), (7, "ÄÖ"), (8, "äö"), (9, "other"), (11, "long " * 50_000), (12, "LONG " * 50_000)]


def brute(rows, best):
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(i)
    return sorted((i, best(groups[lower(t)]), len(groups[lower(t)]), i == best(groups[lower(t)]), hashlib.sha256(lower(t).encode()).hexdigest()) for i, t in rows)


@pytest.mark.parametrize("hash128", [None, lambda data: b"\0" * 16, lambda data: bytes([len(data) % 3]) * 16])
@pytest.mark.parametrize("keep,best", [("smallest", min), ("largest", max)])
def test_like_plain_grouping_even_when_hashes_collide(spark, hash128, keep, best):
    options = {} if hash128 is None else {"hash128": hash128}
    got = exact_groups(frame(spark, ROWS, CLASHING), keep=keep, **options).collect()
    assert sorted(tuple(r) for r in got) == brute(ROWS, best)


def test_null_ids_and_empty_tables(spark):
    got = {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_groups(frame(spark, [(None, "a"), (None, "a"), (None, "b"), (4, "b")])).collect()}
    assert got == {(None, None, 2, True), (None, 4, 2, False), (4, 4, 2, True)}
    assert exact_groups(frame(spark, [])).collect() == []


def test_dropping_keeps_all_columns(spark):
    docs = frame(spark, ROWS, CLASHING)
    left = drop_exact_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 2, 7, 8, 9, 9, 11]


def test_an_id_with_two_texts_loses_the_copy_only(spark):
    docs = frame(spark, [(3, "aaa"), (5, "AAA"), (5, "bbb"), (None, "aaa"), (None, "ccc"), (None, None), (9, ""), (9, "")], CLASHING)
    left = drop_exact_copies(docs)
    assert left.columns == docs.columns
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in left.collect()) == [("3", "aaa"), ("5", "bbb"), ("9", ""), ("9", ""), ("None", "ccc")]
    assert drop_exact_copies(docs.limit(0)).collect() == []
