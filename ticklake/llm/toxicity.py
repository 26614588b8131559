"""Toxicity classifier with a counterfactual penalty.

Labelled sentences that mention a group get a twin in which the group term is swapped for another one of its
axis; a labelled text without any gets a pair that puts two terms of an axis into one of its sentences.  Training
minimises the log loss plus ``penalty`` times the squared difference between the scores of a
sentence and its twin, so a neutral mention of a group does not move the score.

Features say whether a document holds a word, or a word that begins with given four or five letters; only those
that the labelled texts bear out enter the vocabulary.  The model is fitted on a bounded sample of the labelled
rows (``SAMPLE`` rows, the smallest hashes of the ids); every document is scored over its whole text in one pass
without a shuffle.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.llm.common import cut, documents, free, quoted, text_or_empty

SAMPLE = 20_000
VOCABULARY = 4_000
LEAST_DOCUMENTS = 3
PENALTY = 10.0

#: Group terms by axis; the terms of an axis are swapped for each other.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("gay", "straight"), ("lesbian", "heterosexual"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"), ("immigrants", "refugees", "natives"), ("immigrant", "refugee", "native"),
    ("transgender", "cisgender"), ("disabled", "deaf", "blind"), ("old", "young"), ("arab", "african", "european", "american"),
    ("frauen", "männer"), ("frau", "mann"), ("muslime", "christen", "juden"), ("schwule", "lesben"), ("ausländer", "einheimische"),
    ("femmes", "hommes"), ("femme", "homme"), ("musulmans", "chrétiens", "juifs"), ("étrangers", "français"),
    ("mujeres", "hombres"), ("mujer", "hombre"), ("musulmanes", "cristianos", "judíos"), ("extranjeros", "españoles"),
)

WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"(?<=[.!?\n])\s+")


def swaps(axes: tuple[tuple[str, ...], ...] = IDENTITY_TERMS) -> dict[str, str]:
    """Each group term and the next one of its axis."""
    return {term: axis[(i + 1) % len(axis)] for axis in axes for i, term in enumerate(axis)}


def word_features(words: set[str]) -> set[str]:
    """Words, and beginnings of four and five letters marked with ``^``."""
    return words | {f"^{w[:4]}" for w in words if len(w) > 4} | {f"^{w[:5]}" for w in words if len(w) > 5}


def text_features(text: str) -> set[str]:
    return word_features(set(WORD.findall(text.lower())))


def counterfactual(text: str, swap: dict[str, str], axes: tuple[tuple[str, ...], ...] = ()) -> tuple[set[str], set[str]] | None:
    """Features of the sentences of ``text`` that name a group, and of the same with the terms swapped.

    Where no sentence names a group, its first sentence with words gets a term of one of ``axes`` and, as its twin,
    the next term of that axis; the checksum of the text chooses both.  None without words, or without a difference.
    """
    mine, other = set(), set()
    for sentence in SENTENCE.split(text.lower()):
        words = WORD.findall(sentence)
        if any(w in swap for w in words):
            mine |= word_features(set(words))
            other |= word_features({swap.get(w, w) for w in words})
    if not mine and axes and (words := next((w for w in map(set, map(WORD.findall, SENTENCE.split(text.lower()))) if w), None)):
        at = zlib.crc32(text.encode())
        axis = axes[at % len(axes)]
        term = axis[at // len(axes) % len(axis)]
        mine, other = word_features(words | {term}), word_features(words | {swap[term]})
    return (mine, other) if mine != other else None


@dataclass(frozen=True)
class Model:
    """Weights by feature; ``threshold`` is 0.5 on the score.  ``pairs`` says how many counterfactual pairs the fit had."""

    weights: dict[str, float]
    bias: float
    pairs: int = 0

    def score(self, text: str) -> float:
        z = self.bias + sum(self.weights[f] for f in text_features(text) if f in self.weights)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _sampled_features(axes: tuple[tuple[str, ...], ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        swap = swaps(axes)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                own, pairs = [], []
                for text in part.column(1).to_pylist():
                    own.append(sorted(text_features(text)))
                    twin = counterfactual(text, swap, axes)
                    pairs.append(None if twin is None else [sorted(twin[0] - twin[1]), sorted(twin[1] - twin[0])])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(own, pa.list_(pa.string())), pa.array(pairs, pa.list_(pa.list_(pa.string())))], names=["label", "features", "twin"]
                )

    return run


def fit(
    examples: DataFrame, sample: int = SAMPLE, vocabulary: int = VOCABULARY, penalty: float = PENALTY, axes: tuple[tuple[str, ...], ...] = IDENTITY_TERMS
) -> Model:
    """Model from (label 0/1, text) rows of which there are at most ``sample``; ``axes`` lists the group terms.

    Null labels are left out and a null text is empty.  Without rows of both labels no feature tells them apart:
    the model is then the constant share of label 1 (0 without any rows).
    """
    rows = examples.select(F.col("label").cast("int").alias("label"), text_or_empty().alias("text")).where("label is not null")
    stored = cut(rows.mapInArrow(_sampled_features(axes), "label int, features array<string>, twin array<array<string>>"), "toxicity-features")
    n = {r["label"]: r["n"] for r in stored.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total, ones = sum(n.values()), n.get(1, 0)
    if not ones or ones == total:
        return Model({}, float(np.log((ones + 1e-3) / (total - ones + 1e-3))) if total else -30.0)

    # the features that tell the labels apart most surely, by the z-value of their log odds
    seen = stored.select("label", F.explode("features").alias("f")).groupBy("f").agg(F.sum("label").alias("p"), F.count("*").alias("c")).where(f"c >= {LEAST_DOCUMENTS}")
    p, q = F.col("p") + 0.5, F.col("c") - F.col("p") + 0.5
    odds = F.log(p / (ones + 1.0)) - F.log(q / (total - ones + 1.0))
    seen = seen.withColumn("z", F.abs(odds) / F.sqrt(1 / p + 1 / q)).where("z >= 2")
    chosen = [r["f"] for r in seen.orderBy(F.desc("z"), "f").limit(vocabulary).select("f").collect()]
    terms = sorted(set().union(*[word_features({t}) for axis in axes for t in axis])) if axes else []
    chosen = list(dict.fromkeys([*chosen, *terms]))  # group terms are always in, so that the penalty reaches them
    place = {f: i for i, f in enumerate(chosen)}

    listed = stored.mapInArrow(_placed(place), "label int, at array<int>, gone array<int>, came array<int>").collect()  # at most ``sample`` rows
    return Model(*_solve(listed, chosen, penalty), pairs=sum(bool(r["gone"] or r["came"]) for r in listed))


def score_gap(model: Model, texts: list[str], axes: tuple[tuple[str, ...], ...] = IDENTITY_TERMS) -> float:
    """Mean difference of the log odds between the two sides of the texts' counterfactual pairs, 0 without any."""
    swap = swaps(axes)
    weight = lambda fs: sum(model.weights.get(f, 0.0) for f in fs)
    pairs = [p for p in (counterfactual(t, swap, axes) for t in texts) if p]
    return sum(abs(weight(a) - weight(b)) for a, b in pairs) / max(1, len(pairs))


def _placed(place: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, at, gone, came = [], [], [], []
            for row in batch.to_pylist():
                index = lambda fs: [place[f] for f in fs if f in place]
                labels.append(row["label"])
                at.append(index(row["features"]))
                twin = row["twin"] or ([], [])
                gone.append(index(twin[0]))
                came.append(index(twin[1]))
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array(at, ints), pa.array(gone, ints), pa.array(came, ints)], names=["label", "at", "gone", "came"])

    return run


def _solve(rows: list, names: list[str], penalty: float, steps: int = 300, ridge: float = 2e-4) -> tuple[dict[str, float], float]:
    """Full-batch Adam on the log loss, the ridge term and the counterfactual penalty; deterministic."""
    rows = sorted(rows, key=lambda r: (r["label"], r["at"], r["gone"], r["came"]))
    m, n = len(rows), len(names)
    y = np.array([r["label"] for r in rows], float)
    ri = np.repeat(np.arange(m), [len(r["at"]) for r in rows])
    ci = np.array([i for r in rows for i in r["at"]], int)
    twins = [r for r in rows if r["gone"] or r["came"]]
    ti = np.repeat(np.arange(len(twins)), [len(r["gone"]) + len(r["came"]) for r in twins])
    tc = np.array([i for r in twins for i in (*r["gone"], *r["came"])], int)
    ts = np.array([s for r in twins for s in (*[-1.0] * len(r["gone"]), *[1.0] * len(r["came"]))])
    w, b = np.zeros(n), float(np.log(y.mean() / (1 - y.mean())))
    m1, m2 = np.zeros(n + 1), np.zeros(n + 1)
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    for step in range(1, steps + 1):
        z = np.bincount(ri, w[ci], m) + b if len(ci) else np.full(m, b)
        e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * balance / m
        g = np.bincount(ci, e[ri], n) + ridge * w if len(ci) else ridge * w
        if len(tc):
            d = np.bincount(ti, ts * w[tc], len(twins))
            g = g + 2 * penalty / m * np.bincount(tc, ts * d[ti], n)
        g = np.append(g, e.sum())
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        move = 0.05 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-12)
        w, b = w - move[:-1], b - move[-1]
    return {f: float(x) for f, x in zip(names, w, strict=True) if abs(x) > 1e-9}, float(b)


def _scorer(model: Model, score: str):
    """The first column is the text; it makes way for the score, which comes last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                scores = [model.score(t) for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(scores, pa.float64())], names=[*batch.schema.names[1:], score])

    return run


def scored(docs: DataFrame, model: Model, text_col: str = "text", columns: list[str] | None = None, name: str = "score") -> DataFrame:
    """``columns`` of ``docs`` (all by default) and the score, 0 to 1, as ``name``, which none of them may be called.

    Null and empty texts get the score of a text without features.  Rows are scored one by one, so null ids and
    repeated rows are rows like others; an empty table gives an empty result.
    """
    names = docs.columns if columns is None else columns
    # by place, as Spark's map over batches does not take every name
    kept = [F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(names)]
    rows = docs.select(F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit("")).alias("t"), *kept)
    schema = T.StructType([*rows.schema.fields[1:], T.StructField("s", T.DoubleType())])
    return rows.mapInArrow(_scorer(model, "s"), schema).toDF(*names, name)


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", label_col: str = "toxic", held_out: bool = True) -> DataFrame:
    """(label, text) of at most ``sample`` labelled documents, those with the smallest hashes of their ids.

    With ``held_out`` rows whose crc32 of the id as text is divisible by 5 are never learnt from.
    """
    rest = F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(5))
    some = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label in (0, 1)")
    if held_out:
        some = some.where(rest != 0)
    # at most ``sample`` rows of two numbers: small enough for every executor, whatever the corpus holds
    some = some.groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(sample)
    return docs.select(F.col(id_col).alias("id"), text_or_empty().alias("text")).join(F.broadcast(some), "id").select("label", "text")


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    docs = documents(spark, sf_dir)
    model = fit(training_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    out = scored(docs, model, columns=["doc_id"])
    return out.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` that score below 0.5, with all their columns as they are.

    Null and empty texts are scored like others; repeated rows stay or go together; an empty table stays empty, and
    names of further columns do not matter.  Without labels of both kinds the score is their constant share.
    """
    model = fit(training_rows(docs, labels))
    name = free("score", docs.columns)
    kept = scored(docs, model, name=name).where(F.col(name) < 0.5)
    return kept.select(*[F.col(quoted(c)) for c in docs.columns])
