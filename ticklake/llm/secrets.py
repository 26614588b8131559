"""Secret scan with corpus-wide ownership.

Candidates are found row by row.  Every secret value is hashed, and the hashes are counted over the whole corpus by
distinct documents (a document stands for a repository) and distinct owners (the source).  A value that many owners
hold is a copied example; one that a single owner or two hold, of high entropy and no placeholder, looks live.
Candidates of the further kinds are added where they look live; base spans always stay and carry their class.

Owners decide: however many documents a single owner holds a value in, it stays that owner's.  Equal texts count as one
document.  Counting is by distinct (hash, text) and (hash, owner) first and by hash afterwards, all combined map-side,
so a key that a third of all documents quote is no hot group.  Texts are not shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import cut, documents
from ticklake.llm.spans import joined, matches

BASE = ("assign", "access", "hex")
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]++)"""
# with its body: all up to the footer, or without one the rest of the line and the base64 lines below
PRIVATE_KEY = (
    r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----(?:[^-]*+(?:-[^-]++){0,40}+-----END [A-Z ]{0,30}PRIVATE KEY-----"
    r"|[^\r\n-]*+(?:\r?\n[\x20\t]*+[A-Za-z0-9+/=]{16,}+(?=[\x20\t]*(?:[\r\n]|$))){0,500}+)"
)
PATTERNS = {
    "assign": ASSIGN,
    "access": r"AKIA[A-Z0-9]++",
    "hex": r"[0-9a-f]{16,}+",
    "private_key": PRIVATE_KEY,
    "jwt": r"eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+",
    "hub": r"gh[pousr]_[A-Za-z0-9]{30,}+",
    "service": r"(?<![A-Za-z0-9])(?:sk|pk|rk)[-_][A-Za-z0-9_-]{20,}+",
    "bearer": r"Bearer [A-Za-z0-9._~+/-]{20,}+",
}
PLACEHOLDER = r"(?i)(example|changeme|placeholder|dummy|sample|test|your|xxxx|1234567|abcdef|(.)\2{5})"
OWNERS = 3
SEVERAL = 2
DOCUMENTS = 10
ENTROPY = 2.5


def valid(s: Column) -> Column:
    """The checks of the base kinds."""
    return (
        F.when(s["kind"] == "assign", F.length(secret(s)) >= 12)
        .when(s["kind"] == "access", F.length(s["value"]) >= 18)
        .when(s["kind"] == "hex", F.length(s["value"]) >= 16)
        .otherwise(True)
    )


def secret(s: Column) -> Column:
    """The value itself: what is assigned, a private key without white space, or the whole match."""
    key = F.regexp_replace(s["value"], r"\s+|\\[nrt]", "")
    return F.when(s["kind"] == "assign", F.regexp_extract(s["value"], ASSIGN, 2)).when(s["kind"] == "private_key", key).otherwise(s["value"])


def telling(s: Column) -> Column:
    """What is tested for placeholders: of a private key all but its long base64 runs, where any word can come up."""
    return F.when(s["kind"] == "private_key", F.regexp_replace(secret(s), "-----(BEGIN|END)[A-Z]*-----|[A-Za-z0-9+/=]{40,}", "")).otherwise(secret(s))


def varied(s: Column) -> Column:
    """What entropy is computed on: the body of a private key, or its header where it has none; else the value."""
    body = F.regexp_replace(secret(s), "-----(BEGIN|END)[A-Z]*-----", "")
    return F.when((s["kind"] == "private_key") & (body != ""), body).otherwise(secret(s))


def entropy(value: Column) -> Column:
    """Bits per character, over the whole value: a character counts by the length lost without it."""
    n = F.length(value)
    shares = F.transform(F.array_distinct(F.split(value, "")), lambda c: (n - F.length(F.replace(value, c, F.lit("")))) / n)
    return F.aggregate(F.filter(shares, lambda p: p > 0), F.lit(0.0), lambda a, p: a - p * F.log2(p))


def by_place(spans: Column) -> Column:
    """By start, then kind as listed."""
    order = F.create_map(*[x for i, k in enumerate(PATTERNS) for x in (F.lit(k), F.lit(i))])
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.element_at(order, s["kind"]).alias("nth"), s.alias("s")))
    return F.transform(F.array_sort(keyed), lambda x: x["s"])


def candidates(docs: DataFrame, id_col: str, text_col: str, owner_col: str) -> DataFrame:
    """(doc_id, text_key, owner, spans): all candidates of a row, by place, without their text."""
    text = F.col(text_col).cast("string")
    found = F.concat(*[matches(text, p, k) for k, p in PATTERNS.items()])
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_key"), F.col(owner_col).cast("string").alias("owner"), F.filter(found, valid).alias("found"))
    slim = F.transform(
        "found",
        lambda s: F.struct(
            s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.sha2(secret(s).cast("binary"), 256).alias("hash"),
            ((entropy(varied(s)) >= ENTROPY) & ~telling(s).rlike(PLACEHOLDER)).alias("strong"),
        ),
    )
    return rows.select("doc_id", "text_key", "owner", by_place(slim).alias("spans"))


def ownership(found: DataFrame) -> DataFrame:
    """(hash, documents, owners) of every secret value of the corpus; equal texts are one document."""
    each = found.select("text_key", "owner", F.explode("spans.hash").alias("hash"))
    documents = each.select("hash", "text_key").distinct().groupBy("hash").agg(F.count("*").alias("documents"))
    owners = each.select("hash", "owner").distinct().groupBy("hash").agg(F.count("*").alias("owners"))
    return documents.join(owners, "hash")


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source") -> DataFrame:
    """``id_col`` and ``spans`` of every row: kind, start, end, hash, class (``live``, ``example`` or ``weak``), documents, owners.

    ``example``: held by at least ``OWNERS`` owners, or by ``SEVERAL`` in ``DOCUMENTS`` different texts; ``weak``:
    owner-specific, but of little entropy or a placeholder; ``live``: the others.  Null and empty texts have no spans;
    null owners count as one owner.  An empty table gives an empty result; further columns are not read.
    """
    found = cut(candidates(docs, id_col, text_col, owner_col), "secret-candidates")
    held = ownership(found)
    spread = (F.col("owners") >= OWNERS) | ((F.col("owners") >= SEVERAL) & (F.col("documents") >= DOCUMENTS))
    each = found.where(F.size("spans") > 0).select("doc_id", "text_key", F.explode("spans").alias("s")).withColumn("hash", F.col("s.hash"))
    each = each.join(held, "hash").withColumn("class", F.when(spread, "example").when(F.col("s.strong"), "live").otherwise("weak"))
    each = each.where(F.col("s.kind").isin(*BASE) | (F.col("class") == "live"))
    # the spans of one document, at most as many as its text holds
    span = F.struct("s.kind", "s.start", "s.end", "hash", "class", "documents", "owners")
    own = each.groupBy(F.col("doc_id").alias("d"), F.col("text_key").alias("t")).agg(F.collect_set(span).alias("spans"))
    rows = found.select("doc_id", "text_key")
    out = rows.join(own, rows["doc_id"].eqNullSafe(own["d"]) & rows["text_key"].eqNullSafe(own["t"]), "left")
    return out.select(F.col("doc_id").alias(id_col), by_place(F.coalesce("spans", F.array().cast(own.schema["spans"].dataType))).alias("spans"))


def op9_secrets(spark, sf_dir: str) -> DataFrame:
    rows = scanned(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    classed = lambda c: F.size(F.filter("spans", lambda s: s["class"] == c)).cast("long").alias(f"n_{c}")
    return rows.select(
        "doc_id", *[count(k) for k in BASE], F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        classed("live"), classed("example"),
    )
