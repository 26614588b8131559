"""Personal data by weak supervision.

Regular expressions give candidate spans.  Four labelers vote on each: the strict form of its kind, a gazetteer
(top-level domains, issuer prefixes, calling codes, reserved addresses, given names), cue words in front of it, and
free-standing edges.  Expectation-maximisation over the vote patterns of all documents estimates, per kind, how
often each labeler is right, and gives every pattern a probability.  These soft labels train the span classifier, a
naive Bayes model over votes and form, from sums over all candidates.  The classifier then decides in a second pass,
row by row, which candidates beyond the base forms are added.  Base spans always stay.

The driver sees the vote patterns (16 per kind) and the feature sums (a few per kind), never documents.  Neither
pass shuffles texts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import cut, documents
from ticklake.llm.spans import digits, joined, luhn, matches, no_spans

BASE = ("email", "ip", "card", "phone")

#: Candidate patterns by kind.  Possessive repeats and look-behinds keep the scan linear on long runs; the matches
#: are those of the plain forms, as a run is entered at its start or where the last match ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "masked_email": r"[A-Za-z0-9._%+-]{1,64}+\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]{1,63}+(?:\x20?[\[(](?:dot|DOT)[\])]\x20?|\.)[A-Za-z]{2,24}+",
    "local_phone": r"(?<![0-9+(-])(?<!\+[0-9]{1,3}\x20)\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9-])",
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}+(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "person": r"(?:\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sra|Sr)\.? |(?:Name|name|Nom|Nombre): )[A-Z][a-z]{1,30}+(?: [A-Z][a-z]{1,30}+){0,2}+",
}

#: What every text with a match of the kind holds: a literal, or a pattern that fails at once where it is not there.
TITLES = ("Mr", "Ms", "Dr", "Prof", "Herr", "Frau", "Mme", "Sr", "Name: ", "name: ", "Nom: ", "Nombre: ")
NEEDS = {
    "email": ("@",),
    "ip": r"[0-9]\.[0-9]",
    "card": r"[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9]",
    "phone": ("+",),
    "masked_email": r"[\[(](?:at|AT)[\])]",
    "local_phone": r"[0-9]{3}[.-][0-9]{4}",
    "national_id": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "iban": r"[A-Z]{2}[0-9]{2}",
    "person": TITLES,
}

CUES = {
    "email": r"(?i)(e-?mail|mail|contact|write to|kontakt|correo)[^A-Za-z]*$",
    "ip": r"(?i)(ip|host|server|address|client|from)[^A-Za-z]*$",
    "card": r"(?i)(card|visa|mastercard|credit|karte|carte|tarjeta)[^A-Za-z]*$",
    "phone": r"(?i)(phone|tel|call|mobile|fax|telefon|téléphone|teléfono)[^A-Za-z]*$",
    "masked_email": r"(?i)(e-?mail|mail|contact|write to|kontakt|correo)[^A-Za-z]*$",
    "local_phone": r"(?i)(phone|tel|call|mobile|fax|telefon|téléphone|teléfono)[^A-Za-z]*$",
    "national_id": r"(?i)(ssn|social security|tax|passport|id|number)[^A-Za-z]*$",
    "iban": r"(?i)(iban|account|konto|compte|cuenta)[^A-Za-z]*$",
    "person": r"(?i)(signed|contact|dear|from|by|sincerely|patient|employee)[^A-Za-z]*$",
}

GAZETTEER = {
    "email": r"\.(com|org|net|edu|gov|io|co|de|fr|es|uk|info|eu)$",
    "ip": r"^(?!0|10\.|127\.|169\.254\.|192\.168\.|22[4-9]\.|2[3-5][0-9]\.)",
    "card": r"^(4|5[1-5]|2[2-7]|3[47]|6011|65)",
    "phone": r"^\+(1|7|20|27|3[0-9]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])",
    "masked_email": r"(?i)(com|org|net|edu|gov|io|co|de|fr|es|uk|info|eu)$",
    "local_phone": r"^\(?[2-9]",
    "national_id": r"^(?!000|666|9)",
    "iban": r"^(AT|BE|CH|CZ|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE)",
    "person": r"(?i)\b(anna|maria|john|james|mary|peter|paul|michael|thomas|david|sarah|laura|julia|jean|marie|pierre|carlos|jose|juan|ana|hans|klaus)\b",
}

LABELERS = ("strict", "gazetteer", "cue", "edges")
ROUNDS = 20


def strict(s: Column) -> Column:
    """Whether a span passes the checks of its kind; for the base kinds these decide what a base span is."""
    value, kind = s["value"], s["kind"]
    count = F.length(digits(value))
    byte = r"0*(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
    return (
        F.when(kind == "ip", value.rlike(rf"^{byte}\.{byte}\.{byte}\.{byte}$"))
        .when(kind == "card", count.between(13, 19) & luhn(digits(value)))
        .when(kind == "phone", count.between(9, 15))
        .when(kind == "iban", F.length(F.regexp_replace(value, r"\x20", "")).between(15, 34))
        .when(kind == "national_id", ~value.rlike(r"-00-|-0000$"))
        .otherwise(True)
    )


def votes(s: Column) -> list[Column]:
    def by_kind(table: dict[str, str], field: Column) -> Column:
        out = F.lit(False)
        for kind, pattern in table.items():
            out = F.when(s["kind"] == kind, field.rlike(pattern)).otherwise(out)
        return out

    edges = ~s["before"].rlike(r"[A-Za-z0-9_.@/-]$") & ~s["after"].rlike(r"[A-Za-z0-9_@/-]")
    return [strict(s), by_kind(GAZETTEER, s["value"]), by_kind(CUES, s["before"]), edges]


def candidates(text: Column) -> Column:
    """All candidate spans of a text: base kinds as listed, by start, then the further kinds; without those base
    matches that fail their checks."""

    def found(kind: str) -> Column:
        needs = NEEDS[kind]
        there = text.rlike(needs) if isinstance(needs, str) else reduce(lambda a, b: a | b, [text.contains(x) for x in needs])
        return matches(text, PATTERNS[kind], kind, there)

    return F.concat(*[F.filter(found(k), strict) for k in BASE], *[found(k) for k in PATTERNS if k not in BASE])


@dataclass(frozen=True)
class SpanClassifier:
    """Log odds of being personal data by (kind, feature, value); ``prior`` by kind."""

    prior: dict[str, float]
    weights: dict[tuple[str, str, str], float]

    def probability(self, s: Column) -> Column:
        total = F.lit(0.0)
        for kind, p in self.prior.items():
            odds = F.lit(p)
            for name, column in features(s).items():
                table = {v: w for (k, f, v), w in self.weights.items() if k == kind and f == name}
                part = F.lit(0.0)
                for value, weight in sorted(table.items()):
                    part = F.when(column == value, weight).otherwise(part)
                odds = odds + part
            total = F.when(s["kind"] == kind, odds).otherwise(total)
        return 1 / (1 + F.exp(-total))


def features(s: Column) -> dict[str, Column]:
    """Few values each: the votes, length and share of digits in steps."""
    length = F.length(s["value"])
    named = {name: vote.cast("string") for name, vote in zip(LABELERS, votes(s), strict=True)}
    named["length"] = F.least(F.floor(length / 8), F.lit(5)).cast("string")
    named["digits"] = F.floor(4 * F.length(digits(s["value"])) / length).cast("string")
    return named


def reliabilities(patterns: dict[tuple[bool, ...], int], rounds: int = ROUNDS) -> tuple[float, list[tuple[float, float]], dict[tuple[bool, ...], float]]:
    """Two-class expectation-maximisation over counted vote patterns.

    Returns the share of true spans, per labeler (vote when true, vote when false), and the probability per pattern.
    It starts from the belief that a labeler votes for three of four true spans and one of four false ones.
    """
    n = sum(patterns.values())
    share, rates = 0.5, [(0.75, 0.25)] * len(LABELERS)
    posterior: dict[tuple[bool, ...], float] = {}
    for _ in range(rounds):
        for pattern in patterns:
            yes, no = math.log(share), math.log(1 - share)
            for vote, (t, f) in zip(pattern, rates, strict=True):
                yes += math.log(t if vote else 1 - t)
                no += math.log(f if vote else 1 - f)
            posterior[pattern] = 1 / (1 + math.exp(min(700, no - yes)))
        true = sum(c * posterior[p] for p, c in patterns.items())
        share = (true + 1) / (n + 2)
        rates = [
            (
                (sum(c * posterior[p] for p, c in patterns.items() if p[i]) + 0.75 * 2) / (true + 2),
                (sum(c * (1 - posterior[p]) for p, c in patterns.items() if p[i]) + 0.25 * 2) / (n - true + 2),
            )
            for i in range(len(LABELERS))
        ]
    return share, rates, posterior


def train(found: DataFrame) -> SpanClassifier:
    """Classifier from candidate spans (column ``s``); a kind without candidates gets none."""
    voted = found.select("s", *[v.alias(n) for n, v in zip(LABELERS, votes(F.col("s")), strict=True)])
    counted = voted.groupBy("s.kind", *LABELERS).agg(F.count("*").alias("n")).collect()  # at most 16 rows a kind
    by_kind: dict[str, dict[tuple[bool, ...], int]] = {}
    for r in counted:
        by_kind.setdefault(r["kind"], {})[tuple(bool(r[x]) for x in LABELERS)] = r["n"]
    prior, soft = {}, F.lit(0.0)
    for kind, patterns in sorted(by_kind.items()):
        share, _, posterior = reliabilities(patterns)
        prior[kind] = math.log(share / (1 - share))
        for pattern, p in sorted(posterior.items()):
            same = F.col("s.kind") == kind
            for name, vote in zip(LABELERS, pattern, strict=True):
                same = same & (F.col(name) == F.lit(vote))
            soft = F.when(same, p).otherwise(soft)
    named = F.array(*[F.struct(F.lit(n).alias("f"), c.alias("v")) for n, c in features(F.col("s")).items()])
    sums = (
        voted.select("s.kind", soft.alias("p"), F.explode(named).alias("x")).groupBy("kind", "x.f", "x.v")
        .agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()  # a handful of values a feature
    )
    totals: dict[tuple[str, str], tuple[float, float]] = {}
    for r in sums:
        y, n = totals.get((r["kind"], r["f"]), (0.0, 0.0))
        totals[r["kind"], r["f"]] = (y + r["yes"], n + r["no"])
    weights = {}
    for r in sums:
        y, n = totals[r["kind"], r["f"]]
        weights[r["kind"], r["f"], r["v"]] = math.log((r["yes"] + 0.5) / (y + 1)) - math.log((r["no"] + 0.5) / (n + 1))
    return SpanClassifier(prior, weights)


def detected(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``spans`` (kind, start, end, value, before, after) of every row.

    Base kinds first, as listed, then further kinds in the order of ``PATTERNS``; by start within a kind.  Null and
    empty texts have no spans.  Rows are judged one by one, so repeated rows and null ids are rows like others; an empty
    table gives an empty result; further columns are not read.
    """
    text = F.col(text_col).cast("string")
    found = docs.select(F.explode(candidates(text)).alias("s"))
    model = train(cut(found, "pii-candidates"))
    own = docs.select(F.col(id_col), candidates(text).alias("spans"))
    base = lambda s: s["kind"].isin(*BASE)
    kept = F.filter("spans", lambda s: base(s) | (model.probability(s) >= 0.5))
    return own.select(id_col, F.when(F.size("spans") > 0, kept).otherwise(no_spans()).alias("spans"))


def op8_pii(spark, sf_dir: str) -> DataFrame:
    rows = detected(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return rows.select("doc_id", *[count(k) for k in BASE], F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
