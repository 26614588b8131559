"""The pipeline against plain versions of its stages."""

from collections import defaultdict

import corpus_pipeline
from helpers import CLASHING, frame, lower, near_components
from ticklake.llm.mixing import labelled, mix
from ticklake.llm.toxicity import fit, training_rows


def test_stages_like_plain_versions(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]
    model = fit(training_rows(docs, labels))
    rows = {r["doc_id"]: r["text"] for r in docs.collect() if model.score(r["text"] or "") < 0.5}
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}

    one = stages["toxicity"](spark, docs, sf)
    assert ids(one) == set(rows) and one.columns == docs.columns
    first = defaultdict(list)
    for i, t in rows.items():
        first[lower(t)].append(i)
    rows = {i: rows[i] for group in first.values() for i in [min(group)]}
    two = stages["exact_dedup"](spark, one, sf)
    assert ids(two) == set(rows) and two.columns == docs.columns
    comp, _ = near_components(list(rows.items()), 80)
    rows = {i: t for i, t in rows.items() if comp[i] == i}
    three = stages["near_dedup"](spark, two, sf)
    assert ids(three) == set(rows) and three.columns == docs.columns
    kept = {r["doc_id"] for r in mix(labelled(three)).collect() if r["copies"]}
    four = stages["mixing"](spark, three, sf)
    assert ids(four) == kept and four.columns == docs.columns
    out = corpus_pipeline.run(spark, sf).collect()
    assert {r["doc_id"] for r in out} == kept
    tokens = defaultdict(int)
    for r in out:
        tokens[r["doc_id"]] += r["length"]
    assert all(tokens[r["doc_id"]] == r["doc_tokens"] for r in out)


def test_stages_take_odd_tables(spark, sf):
    odd = frame(spark, [(None, None), (1, ""), (1, ""), (2, "some words here"), (2, "some words here")], CLASHING)
    for table in (odd, odd.limit(0)):
        docs = table
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf)
            if name != "packing":
                assert out.columns == docs.columns
                docs = out
        out.collect()
