"""Mixing sources to target weights by iterative proportional fitting (raking).

Token weights are summed into cells of source, language and topic, and the cells are scaled until their sums meet
the target share of every source, language and topic.  Only cells are iterated over; documents are read twice,
for the sums and for the sampling.  A document is then kept with the probability of its cell, decided by a hash
of its id: the same document always gets the same decision, on any partitioning.  All of it is DataFrame code.

Every step of the fit sums by another dimension.  Up to ``CELLS_PER_TASK`` cells are one partition throughout, so a
step needs no shuffle; more are dealt out anew for every step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticklake.llm.common import cut, documents, text_or_empty

DIMENSIONS = ("source", "lang", "topic")
#: Targets of the query: the observed share to this power, made to sum to 1.  1 keeps a dimension as it is.
EXPONENTS = {"source": 0.9, "lang": 0.9, "topic": 1.0}
SWEEPS = 12
#: The documents of a value go down to this times its target share of all tokens; values that hold less stay whole.
RATE = 1.0
#: As ``rate`` of ``mix``: the largest at which no document is expected twice.  The scarcest cell sets it.
LARGEST = "largest"
CUT_EVERY = 4
CELLS_PER_TASK = 100_000
NONE = "(none)"

#: Topic by the form of a text, the first that holds; (name, SQL pattern).  Texts without any of them are prose.
TOPICS = (
    ("table", r"( \| .*){3}"),
    ("license", r"(License|Licence|license|All rights reserved|Copyright)"),
    ("contact", r"(@[A-Za-z0-9-]+\.|\+[0-9] ?\()"),
    ("credentials", r"(AKIA[A-Z0-9]|password|token)"),
)


def topic(text: Column) -> Column:
    out = F.lit("prose")
    for name, pattern in reversed(TOPICS):
        out = F.when(text.rlike(pattern), name).otherwise(out)
    return out


def tokens(text: Column) -> Column:
    """Token weight of a text: its words and marks by white space, at least 1."""
    return F.greatest(F.lit(1), F.regexp_count(text, F.lit("[^ \t\n\r]+"))).cast("long")


def draw(id_col: Column) -> Column:
    """Uniform in [0, 1) from the id."""
    digest = F.md5(F.coalesce(id_col.cast("string"), F.lit("null")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def tempered(cells: DataFrame, dimension: str, exponent: float) -> DataFrame:
    """(dimension, target): observed shares to a power."""
    own = cells.groupBy(dimension).agg(F.sum("tokens").alias("mass"))
    total = own.agg(F.sum(F.pow("mass", F.lit(exponent))).alias("total"))
    # one row against the dimension's values
    return own.join(F.broadcast(total)).select(dimension, (F.pow("mass", F.lit(exponent)) / F.col("total")).alias("target"))


def stated(cells: DataFrame, dimension: str, shares: dict[str, float]) -> DataFrame:
    """(dimension, target) from given shares; values that do not occur cannot be filled and are left out,
    values without a share get none of the mass."""
    listed = F.create_map(*[x for k, v in shares.items() for x in (F.lit(k), F.lit(float(v)))])
    own = cells.select(dimension).distinct().withColumn("share", F.coalesce(F.element_at(listed, F.col(dimension)), F.lit(0.0)))
    total = own.agg(F.sum("share").alias("total"))
    return own.join(F.broadcast(total)).select(dimension, F.coalesce(F.try_divide("share", "total"), F.lit(0.0)).alias("target"))


def dealt_cells(table: DataFrame, one: bool) -> DataFrame:
    """``table`` as one partition where ``one``.  What is summed by any key is in one place then: each shuffle saved is
    a job and its stages less on the driver."""
    return table.coalesce(1) if one else table


def rake(cells: DataFrame, targets: dict[str, DataFrame], sweeps: int = SWEEPS, whole: bool = False, one: bool = False) -> DataFrame:
    """``cells`` with ``fitted``: shares that meet the targets of every dimension, one dimension after the other.
    With ``whole`` no cell is fitted above what it holds, and the others make up for it; with ``one`` the cells are few
    enough for one partition.

    The windows run over cells, not documents: a source has as many rows as languages times topics, however many
    documents it holds.  The last dimension is met exactly, the others up to what the sweeps leave.
    """
    total = cells.agg(F.sum("tokens").cast("double").alias("total"))
    state = cells.join(F.broadcast(total)).withColumn("held", F.col("tokens") / F.col("total")).withColumn("fitted", F.col("held")).drop("total")
    for dimension, target in targets.items():
        state = state.join(target.withColumnRenamed("target", f"target_{dimension}"), dimension)
    state = dealt_cells(cut(state, "cells"), one)
    for sweep in range(1, sweeps + 1):
        for dimension in targets:
            mass = F.sum("fitted").over(Window.partitionBy(dimension))
            scaled = F.col("fitted") * F.coalesce(F.try_divide(f"target_{dimension}", mass), F.lit(0.0))
            state = state.withColumn("fitted", F.least("held", scaled) if whole else scaled)
        if sweep % CUT_EVERY == 0 or sweep == sweeps:
            state = dealt_cells(cut(state, "cells"), one)
    return state


def reachable(cells: DataFrame, targets: dict[str, DataFrame], rate: float = RATE, one: bool = False) -> tuple[dict[str, DataFrame], float]:
    """Masses per dimension, as shares of all tokens, that documents kept at most once can fill, and their common sum.

    A value gets the smaller of what it holds and a multiple of its target.  The multiple is at most ``rate``, and
    such that all dimensions sum to the same.  A scarce value stays whole and moves the sum by no more than its own
    target.  The window runs over the values of a dimension, which with ``one`` are one partition, like the cells.
    """
    total = F.broadcast(cells.agg(F.sum("tokens").cast("double").alias("total")))
    held = {}
    for d, target in targets.items():
        own = cells.groupBy(d).agg(F.sum("tokens").alias("mass")).join(total).select(d, (F.col("mass") / F.col("total")).alias("mass"))
        held[d] = dealt_cells(cut(own.join(target, d), "masses"), one)
    sums = [held[d].agg(F.sum(F.least("mass", F.lit(rate) * F.col("target")))).first()[0] or 0.0 for d in targets]
    common = min(sums, default=0.0)
    out = {}
    for d, own in held.items():
        order = Window.orderBy(F.try_divide("mass", "target").asc_nulls_last(), d)
        below = F.coalesce(F.sum("mass").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
        rest = F.sum("target").over(order.rowsBetween(0, Window.unboundedFollowing))
        # sum(least(mass, k * target)) is the least over the values of below + k * rest, so k is the largest solution
        k = own.select(F.try_divide(F.lit(common) - below, rest).alias("k")).agg(F.coalesce(F.max("k"), F.lit(0.0)).alias("k"))
        out[d] = own.join(F.broadcast(k)).select(d, F.least("mass", F.col("k") * F.col("target")).alias("target"))
    return out, common


def labelled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text = text_or_empty(text_col)
    none = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(NONE)).alias(c)
    return docs.select(F.col(id_col).alias("doc_id"), none("source"), none("lang"), topic(text).alias("topic"), tokens(text).alias("tokens"))


def mix(rows: DataFrame, targets: dict[str, float | dict[str, float]] | None = None, sweeps: int = SWEEPS, rate: float | str | None = None) -> DataFrame:
    """``rows`` (doc_id, source, lang, topic, tokens) with ``factor``, ``probability`` and ``copies``.

    ``targets`` gives per dimension an exponent for the observed shares, or shares by value.  ``factor`` is the
    fitted share of the cell over its observed share.  ``probability`` is the expected number of copies, rate x
    factor.  By default no document is repeated and the masses of ``reachable`` are fitted: values with more than
    their target go down to it, scarce ones stay whole, and a rare value does not change what is kept of the others.
    With a number as ``rate`` documents of scarce cells are repeated; with ``LARGEST`` samples of all cells are in
    the fitted proportions, which the scarcest cell pays for with documents of all others.
    ``copies`` is the drawn number, 0 for documents that go.

    Null sources and languages form the value ``(none)``.  Rows with the same id get the same draw; null ids
    share one.  An empty table gives an empty result.
    """
    targets = EXPONENTS if targets is None else targets
    cells = cut(rows.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), "cells")
    one = cells.count() <= CELLS_PER_TASK
    cells = dealt_cells(cells, one)
    wanted = {d: tempered(cells, d, t) if isinstance(t, (int, float)) else stated(cells, d, t) for d, t in targets.items()}
    observed = cells.agg(F.sum("tokens").cast("double").alias("total"))
    once = rate is None
    if once:
        wanted, rate = reachable(cells, wanted, one=one)
    fitted = rake(cells, wanted, sweeps, whole=once, one=one).join(F.broadcast(observed))
    if once:
        fitted = fitted.withColumn("fitted", F.coalesce(F.try_divide("fitted", F.lit(rate)), F.lit(0.0)))
    fitted = cut(fitted.select(*DIMENSIONS, (F.col("fitted") * F.col("total") / F.col("tokens")).alias("factor")), "factors")
    if rate == LARGEST:
        rate = 1 / (fitted.agg(F.max("factor")).first()[0] or 1.0)
    expected = F.round(F.lit(rate) * F.col("factor"), 9)
    expected = F.least(F.lit(1.0), expected) if once else expected
    whole = F.floor(expected)
    copies = whole + F.when(draw(F.col("doc_id")) < expected - whole, 1).otherwise(0)
    return rows.join(fitted, list(DIMENSIONS)).select(
        "doc_id", *DIMENSIONS, "tokens", F.round("factor", 6).alias("factor"), expected.alias("probability"), copies.cast("long").alias("copies")
    )


def sample_documents(docs: DataFrame, targets: dict | None = None) -> DataFrame:
    """Rows of ``docs`` drawn to the targets, at most once each, with all their columns as they are.  Cells that fall
    short of their targets stay whole."""
    base = labelled(docs)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    keyed = whole.select(
        "_row", F.col("_row.doc_id").alias("doc_id"), F.coalesce(F.col("_row.source").cast("string"), F.lit(NONE)).alias("source"),
        F.coalesce(F.col("_row.lang").cast("string"), F.lit(NONE)).alias("lang"), topic(F.coalesce(F.col("_row.text"), F.lit(""))).alias("topic"),
    )
    factors = mix(base, targets).select(*DIMENSIONS, "probability").distinct()
    chosen = keyed.join(cut(factors, "probabilities"), list(DIMENSIONS)).where(draw(F.col("doc_id")) < F.col("probability"))
    return chosen.select("_row.*")


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    """At the rate that ``OP5_SQL`` states."""
    return mix(labelled(documents(spark, sf_dir)), rate=LARGEST)


def _sql() -> str:
    cases = " ".join(f"WHEN regexp_matches(t, '{pattern}') THEN '{name}'" for name, pattern in TOPICS)
    parts = [
        f"d AS (SELECT doc_id, coalesce(source, '{NONE}') AS source, coalesce(lang, '{NONE}') AS lang, coalesce(text, '') AS t FROM documents)",
        f"r AS (SELECT doc_id, source, lang, CASE {cases} ELSE 'prose' END AS topic, greatest(1, len(regexp_extract_all(t, '[^ \\t\\n\\r]+'))) AS tokens FROM d)",
        "c AS (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM r GROUP BY ALL)",
    ]
    for d, e in EXPONENTS.items():
        parts.append(f"m_{d} AS (SELECT {d}, sum(tokens) AS mass FROM c GROUP BY 1)")
        parts.append(f"t_{d} AS (SELECT {d}, pow(mass, {e}) / (SELECT sum(pow(mass, {e})) FROM m_{d}) AS target_{d} FROM m_{d})")
    joins = " ".join(f"JOIN t_{d} USING ({d})" for d in EXPONENTS)
    parts.append(f"s0 AS MATERIALIZED (SELECT c.*, tokens / (SELECT sum(tokens) FROM c) AS fitted, {', '.join(f'target_{d}' for d in EXPONENTS)} FROM c {joins})")
    last = 0
    for _ in range(SWEEPS):
        for d in EXPONENTS:
            parts.append(f"s{last + 1} AS MATERIALIZED (SELECT * REPLACE (fitted * target_{d} / sum(fitted) OVER (PARTITION BY {d}) AS fitted) FROM s{last})")
            last += 1
    parts.append(f"f AS (SELECT source, lang, topic, fitted * (SELECT sum(tokens) FROM c) / tokens AS factor FROM s{last})")
    parts.append("p AS (SELECT r.*, factor, round(factor * (1 / (SELECT max(factor) FROM f)), 9) AS probability FROM r JOIN f USING (source, lang, topic))")
    draw_sql = "('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT / 4294967296.0"
    return (
        "WITH " + ",\n".join(parts) + "\nSELECT doc_id, source, lang, topic, tokens, round(factor, 6) AS factor, probability, "
        f"(floor(probability) + CASE WHEN {draw_sql} < probability - floor(probability) THEN 1 ELSE 0 END)::BIGINT AS copies FROM p"
    )


OP5_SQL = _sql()
