import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from helpers import CLASHING, frame
from ticklake.llm import best_fit_packing as bf
from ticklake.llm import histogram_packing as hp

TEXTS = [
    "Hello  World\n\tit's 2024!", "", None, "é é ﬁ Ⅻ  x y \x1c z", "ÀÉÎ ẞ İ ΑΣ ΑΣ\n", "<|endoftext|> a<|startoftext|>b", "日本語 テキスト 😀😀 👩‍👩‍👧",
    "we'll don't 's 't", "x" * 5000, "word " * 9000, " ", "a\r\nb\x0bc\x85d", "same text", "same text",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def rows_of(spark):
    return frame(spark, list(enumerate(TEXTS)) + [(12, TEXTS[12])], CLASHING)


def test_pieces_hold_the_tokenizers_ids(spark, tokenizer):
    parts = defaultdict(dict)
    for r in hp.token_pieces(frame(spark, list(enumerate(TEXTS)), CLASHING)).collect():
        parts[r["doc_id"]][r["start"]] = r
    for i, text in enumerate(TEXTS):
        whole = b"".join(p["ids"] for _, p in sorted(parts[i].items()))
        assert np.frombuffer(whole, "<u4").tolist() == ids_of(tokenizer, text), text
        assert {p["doc_tokens"] for p in parts[i].values()} == {len(whole) // 4}


def test_report_covers_every_id_once_and_is_gapless(spark, tokenizer):
    rows = hp.pack_report(rows_of(spark)).collect()
    sequences = defaultdict(list)
    for r in rows:
        ids = ids_of(tokenizer, TEXTS[r["doc_id"]])[r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) == r["ids_crc32"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert Counter(r["doc_id"] for r in rows if r["start"] == 0) == Counter([*range(len(TEXTS)), 12])
    assert sorted(sequences) == list(range(len(sequences)))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048


def test_little_padding_on_given_documents(spark):
    rows = hp.op2_packing(spark, "/root/testdata/sf0.01").collect()
    full = len({r["sequence_id"] for r in rows}) * 2048
    assert sum(r["length"] for r in rows) > 0.98 * full


def test_patterns_place_every_length(spark):
    rng = random.Random(1)
    for _ in range(60):
        histogram = {rng.randint(1, 64): rng.randint(1, 500) for _ in range(rng.randint(1, 60))}
        placed = Counter()
        for times, pattern in hp.plan_patterns(histogram, 64):
            assert times > 0 and sum(n * m for n, m in pattern) <= 64
            placed.update({n: 0 for n, _ in pattern})
            for n, m in pattern:
                placed[n] += times * m
        assert placed == histogram
    assert hp.plan_patterns({}, 64) == []


def test_hot_lengths_and_ties(spark):
    pieces = spark.createDataFrame([(i % 3, 0, 5 if i % 4 else 60) for i in range(400)], "doc_id long, start long, length long")
    rows = hp.pack_pieces(pieces, 64).collect()
    assert len(rows) == 400 and len({(r["sequence_id"], r["offset"]) for r in rows}) == 400


def test_empty_tables(spark):
    assert hp.pack_report(frame(spark, [])).collect() == []
    assert bf.packed_matrices(frame(spark, [])).collect() == []


def test_best_fit_like_a_plain_search():
    rng = random.Random(5)
    for _ in range(40):
        lengths = [rng.randint(1, 50) for _ in range(rng.randint(0, 200))]
        room, want = [], []
        for i in sorted(range(len(lengths)), key=lambda j: -lengths[j]):
            fitting = [r for r in room if r >= lengths[i]]
            if fitting:
                room[room.index(min(fitting))] -= lengths[i]
            else:
                room.append(50 - lengths[i])
        got = bf.best_fit(lengths, 50)
        assert sorted(x for row in got for x in row) == list(range(len(lengths)))
        want = sorted(room)
        assert sorted(50 - sum(lengths[i] for i in row) for row in got) == want


def test_matrices_round_trip(spark, tokenizer):
    docs = frame(spark, list(enumerate(TEXTS)), CLASHING)
    matrices = bf.packed_matrices(docs, block=9000)
    for r in matrices.collect():
        ids, places, ends = np.frombuffer(r["ids"], "<u4"), np.frombuffer(r["positions"], "<u4"), r["cu_seqlens"]
        assert len(ids) == len(places) == 2048 and ends[0] == 0 and ends[-1] == r["n_tokens"] <= 2048
        assert len(ends) == len(r["doc_ids"]) + 1 == len(r["starts"]) + 1
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            assert places[a:b].tolist() == list(range(b - a))
        assert not ids[r["n_tokens"] :].any()
    got = {r["doc_id"]: np.frombuffer(bytes(r["ids"]), "<u4").tolist() for r in bf.unpacked(matrices).collect()}
    assert got == {i: ids_of(tokenizer, t) for i, t in enumerate(TEXTS)}


def test_written_matrices_are_read_back(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bf.write_matrices(bf.packed_matrices(docs), f"{tmp_path}/m")
    back = bf.unpacked(spark.read.parquet(f"{tmp_path}/m"))
    parts = hp.token_pieces(docs).groupBy("doc_id").agg({"length": "sum"}).collect()
    assert {r["doc_id"]: len(r["ids"]) // 4 for r in back.collect()} == {r[0]: r[1] for r in parts}
