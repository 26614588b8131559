import math
import zlib

from helpers import CLASHING, frame
from ticklake.llm.toxicity import counterfactual, drop_toxic, fit, op1_toxicity, score_gap, scored, swaps, text_features, training_rows


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in op1_toxicity(spark, sf).collect()}
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    held = [(got[i]["predicted"], y) for i, y in truth.items() if got[i]["held_out"]]
    assert sum(p == y for p, y in held) >= 0.93 * len(held)
    clean = [p for p, y in held if not y]
    assert sum(clean) <= 0.02 * len(clean)


def group_table():
    """Insults are toxic; women and muslims are named in more toxic texts than men and christians."""
    rows, own = [], []
    for i in range(600):
        toxic = i % 3 == 0
        group = ("women" if i % 2 else "muslims") if toxic or i % 12 == 1 else ("men" if i % 2 else "christians")
        insult = ("scum", "idiots", "vermin")[i % 9 // 3] if toxic else ("kind", "present", "early")[i % 9 // 3]
        rows.append((i, f"Some words came first. The {group} were called {insult}. Then it ended."))
        own.append((i, 1, int(toxic)))
    return rows, own


def test_penalty_evens_out_group_terms(spark):
    rows, own = group_table()
    examples = training_rows(frame(spark, rows), labels(spark, own))
    free, held = fit(examples, penalty=0.0), fit(examples, penalty=50.0)
    odds = lambda p: math.log(p / (1 - p))
    gap = lambda m: abs(odds(m.score("the women were present")) - odds(m.score("the men were present")))
    assert gap(free) > 0.3 and gap(held) < 0.25 * gap(free)
    assert held.score("the women were present") < 0.5 < held.score("the men were called scum idiots")


def test_pairs_act_on_the_given_tables(spark):
    """The invented prose names no group, so each labelled text gets a pair; the penalty narrows their gap."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    examples = training_rows(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    texts = [r["text"] for r in examples.collect()]
    # terms that also occur in the tables, among them words that toxic texts hold more often than others
    seen = {}
    for r in examples.collect():
        for w in text_features(r["text"]):
            if not w.startswith("^"):
                seen.setdefault(w, [0, 0])[r["label"]] += 1
    often = [w for w in sorted(seen, key=lambda w: (seen[w][0] * 0.2 - seen[w][1], w)) if sum(seen[w]) >= 5]
    axes = (*[(a, b) for a, b in zip(often[:20], often[-20:], strict=True)],)
    free, held = fit(examples, penalty=0.0, axes=axes), fit(examples, penalty=200.0, axes=axes)
    assert free.pairs == held.pairs > 0.9 * len(texts)
    assert score_gap(free, texts, axes) > 0.1 and score_gap(held, texts, axes) < 0.5 * score_gap(free, texts, axes)
    plain = fit(examples)
    assert plain.pairs > 0.9 * len(texts)


def test_a_pair_is_made_where_no_group_is_named():
    axes = (("men", "women"),)
    swap = swaps(axes)
    mine, other = counterfactual("... \nOne two. Three.", swap, axes)
    assert mine ^ other == {"men", "women", "^wome"} and {"one", "two"} <= mine & other and "three" not in mine
    assert counterfactual("...", swap, axes) is None and counterfactual("", swap, axes) is None
    assert counterfactual("No group.", swap) is None
    mine, other = counterfactual("No group. The men here.", swap, axes)
    assert "men" in mine and "women" in other and "group" not in mine


def test_edges(spark):
    rows, own = group_table()
    model = fit(training_rows(frame(spark, rows, CLASHING), labels(spark, [*own, (None, None, None), (10**9, 1, 1), (0, 1, None)])))
    docs = frame(spark, [(1, None), (2, ""), (None, "scum idiots vermin"), (3, "word " * 300_000), (3, "same"), (3, "same")], CLASHING)
    out = scored(docs, model, name="_p").collect()
    assert len(out) == 6 and all(0 <= r["_p"] <= 1 for r in out)
    assert out[0]["_p"] == out[1]["_p"]
    left = drop_toxic(docs, labels(spark, own))
    assert left.columns == docs.columns and None not in {r["doc_id"] for r in left.collect()}


def test_without_labels_the_model_is_constant(spark):
    none = fit(training_rows(frame(spark, [(1, "a")]), labels(spark, [])))
    one = fit(training_rows(frame(spark, [(1, "a"), (2, "b"), (3, "c")]), labels(spark, [(1, 1, 0), (2, 1, 0), (3, 1, 0)])))
    assert none.score("a") < 0.5 and one.score("a") < 0.5
    assert scored(frame(spark, []), none).collect() == []


def test_swaps_and_features():
    swap = swaps()
    assert swap["women"] == "men" and swap["men"] == "women" and swap["jewish"] == "hindu"
    assert text_features("Abcdefg x") == {"abcdefg", "x", "^abcd", "^abcde"}
