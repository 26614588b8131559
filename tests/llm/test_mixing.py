from collections import defaultdict

import pytest

from helpers import CLASHING, frame, plan
from ticklake.llm import mixing
from ticklake.llm.mixing import EXPONENTS, labelled, mix, op5_mixing, sample_documents


def shares(rows, key, weight):
    out = defaultdict(float)
    for r in rows:
        out[r[key]] += weight(r)
    total = sum(out.values())
    return {k: v / total for k, v in out.items()}


def test_marginals_meet_the_targets(spark):
    rows = op5_mixing(spark, "/root/testdata/sf0.01").collect()
    for dimension, exponent in EXPONENTS.items():
        have = shares(rows, dimension, lambda r: r["tokens"])
        norm = sum(v**exponent for v in have.values())
        got = shares(rows, dimension, lambda r: r["tokens"] * r["factor"])
        for value, share in have.items():
            assert got[value] == pytest.approx(share**exponent / norm, rel=1e-3)
    assert max(r["probability"] for r in rows) == 1 and {r["copies"] for r in rows} <= {0, 1}
    expected = sum(r["probability"] for r in rows)
    assert abs(sum(r["copies"] for r in rows) - expected) < 4 * sum(r["probability"] * (1 - r["probability"]) for r in rows) ** 0.5 + 1


def test_stated_shares_and_repeats(spark):
    rows = [(i, "one two three", "en" if i % 4 else "de", f"s{i % 2}") for i in range(400)]
    out = mix(labelled(frame(spark, rows)), {"lang": {"en": 0.5, "de": 0.5, "fr": 0.4}}, rate=1.0).collect()
    got = shares(out, "lang", lambda r: r["tokens"] * r["copies"])
    assert got["de"] == pytest.approx(0.5, abs=0.06) and max(r["copies"] for r in out) == 2


def test_no_python_on_the_main_path(spark, sf):
    text = plan(op5_mixing(spark, sf))
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text and "CartesianProduct" not in text


def test_edges(spark):
    rows = [(1, None, None, None), (2, "", "en", None), (None, "a b", "en", "s"), (None, "a b", "en", "s"), (3, "x " * 200_000, "de", "s"), (3, "x", "de", "s")]
    docs = frame(spark, rows, CLASHING)
    out = mix(labelled(docs)).collect()
    assert len(out) == 6 and all(0 < r["probability"] <= 1 for r in out)
    left = sample_documents(docs)
    assert left.columns == docs.columns and left.count() == sum(r["copies"] for r in out)
    assert mix(labelled(frame(spark, []))).collect() == [] and sample_documents(frame(spark, [])).collect() == []


@pytest.mark.parametrize("rare", [("xx", "rare"), (None, None)])
def test_a_rare_value_does_not_set_the_rate(spark, rare):
    rows = [(i, "word " * 400, "en" if i % 3 else "de", f"s{min(i % 7, 2)}") for i in range(4000)]
    clean = {r["doc_id"]: r["probability"] for r in mix(labelled(frame(spark, rows))).collect()}
    docs = frame(spark, [*rows, (9999, "one two three", *rare)])
    out = mix(labelled(docs)).collect()
    mean = lambda p: sum(p) / len(rows)
    assert mean(clean.values()) > 0.95
    assert mean(r["probability"] for r in out if r["doc_id"] != 9999) == pytest.approx(mean(clean.values()), abs=0.01)
    assert max(r["probability"] for r in out) <= 1 and [r["copies"] for r in out if r["doc_id"] == 9999] == [1]
    # what has more than its target goes down to the same shares of what is left
    for dimension, value in (("source", "s2"), ("lang", "en")):
        was = shares(out, dimension, lambda r: r["tokens"])
        got = shares(out, dimension, lambda r: r["tokens"] * r["probability"])
        assert got[value] < was[value]
    kept = {r["doc_id"] for r in sample_documents(docs).collect()}
    assert kept == {r["doc_id"] for r in out if r["copies"]}


def test_scarce_values_stay_whole_and_the_others_meet_their_targets(spark):
    rows = [(i, "one two three", "en" if i % 2 else "de", "a" if i < 700 else "b" if i < 950 else "c") for i in range(1000)]
    out = mix(labelled(frame(spark, rows)), {"source": {"a": 0.4, "b": 0.2, "c": 0.4}, "lang": 1.0}).collect()
    got = defaultdict(float)
    for r in out:
        got[r["source"]] += r["probability"]
        got[r["lang"]] += r["probability"]
    assert got["a"] == pytest.approx(400, rel=0.01) and got["b"] == pytest.approx(200, rel=0.01) and got["c"] == pytest.approx(50)
    assert got["en"] == pytest.approx(325, rel=0.01) and got["de"] == pytest.approx(325, rel=0.01)


def many_cells(spark):
    return frame(spark, [(i, "one two three" + " four" * (i % 5), f"l{i % 11}", f"s{i % 7}") for i in range(800)])


def test_few_cells_are_fitted_without_a_shuffle_for_every_step(spark):
    context = spark.sparkContext
    context.setJobGroup("mixing", "jobs of one sample")
    try:
        sample_documents(many_cells(spark)).collect()
        jobs = context.statusTracker().getJobIdsForGroup("mixing")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        context.setLocalProperty("spark.job.description", None)
    assert 0 < len(jobs) < 70


def test_one_partition_and_many_give_the_same(spark, monkeypatch):
    key = lambda r: r["doc_id"]
    one = sorted(mix(labelled(many_cells(spark))).collect(), key=key)
    monkeypatch.setattr(mixing, "CELLS_PER_TASK", 0)
    many = sorted(mix(labelled(many_cells(spark))).collect(), key=key)
    assert [(r["doc_id"], r["copies"]) for r in one] == [(r["doc_id"], r["copies"]) for r in many]
    assert [r["probability"] for r in one] == pytest.approx([r["probability"] for r in many], abs=1e-8)
