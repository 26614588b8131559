"""Line deduplication over overlapping windows of three lines.

Lines that are not blank are numbered within their document and every three consecutive ones are hashed to 128
bits.  A window that occurs more than once in the corpus keeps its first occurrence, by document id and line; every
later occurrence covers its three lines, overlapping coverages merge, and covered lines go.  Only (hash, document id,
number of the window) is shuffled; the lines a window covers are found again from the text.  Counting combines
map-side, so a passage in a third of all documents is a handful of partial counts.  Both joins shuffle at every size:
what they look up grows with the corpus, and the adaptive skew join can split them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import cut, documents, text_or_empty

LINES = 3


def solid_lines(text: Column) -> Column:
    """(i, line): the lines that are not blank, without the blanks around them."""
    numbered = F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("i"), F.trim(x).alias("line")))
    return F.filter(numbered, lambda x: x["line"] != "")


def window_hashes(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """(doc_id, at, hash): windows of ``lines`` consecutive lines that are not blank, numbered from 0."""
    rows = docs.withColumn("solid", solid_lines(F.col("text"))["line"]).where(F.size("solid") >= lines)
    made = F.transform(F.sequence(F.lit(1), F.size("solid") - (lines - 1)), lambda at: F.unhex(F.md5(F.array_join(F.slice("solid", at, lines), "\n").cast("binary"))))
    return rows.select("doc_id", F.posexplode(made).alias("at", "hash"))


def later_windows(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """(doc_id, later): for every document with later repeats, the numbers of those windows."""
    seen = window_hashes(docs, lines)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "at")
    repeated = seen.groupBy("hash").agg(F.count("*").alias("n"), F.min(order).alias("first")).where("n > 1").select("hash", "first")
    later = seen.join(repeated.hint("merge"), "hash").where(order > F.col("first"))
    return later.groupBy("doc_id").agg(F.collect_set("at").alias("later"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lines: int = LINES) -> DataFrame:
    """``id_col``, ``text`` without later repeats, ``n_lines`` (not blank) and ``n_removed`` of every row.

    Lines are compared without the blanks around them.  Blank lines belong to no window and stay.  Texts of fewer
    than ``lines`` lines, empty and null ones (returned as empty) are returned as they are.  Rows with the same id
    are one document: what one of them repeats is removed from all; rows with a null id come last in the order and
    count as one document as well.  An empty table gives an empty result; further columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    own = cut(later_windows(rows, lines), "later-windows").select(F.col("doc_id").alias("d"), "later")
    joined = rows.join(own.hint("merge"), rows["doc_id"].eqNullSafe(own["d"]), "left")
    numbers = F.col("solid")["i"]
    # a repeated id has windows of all its rows: those beyond the end of this row cover nothing
    lines_of = F.array_distinct(F.flatten(F.transform("later", lambda at: F.slice(numbers, at + 1, lines))))
    joined = joined.withColumn("solid", F.when(F.col("later").isNotNull(), solid_lines(F.col("text")))).withColumn("covered", lines_of)
    split = F.split("text", "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("covered"))
    return (
        joined.withColumn("lines", split).withColumn("kept", kept)
        .select(
            F.col("doc_id").alias(id_col),
            F.when(F.col("covered").isNull(), F.col("text")).otherwise(F.array_join(F.transform("kept", lambda i: F.get("lines", i)), "\n")).alias("text"),
            F.size(F.filter("lines", lambda x: F.trim(x) != "")).cast("long").alias("n_lines"),
            F.when(F.col("covered").isNull(), 0).otherwise(F.size("lines") - F.size("kept")).cast("long").alias("n_removed"),
        )
    )


def op3_line_dedup(spark, sf_dir: str) -> DataFrame:
    return deduplicated(documents(spark, sf_dir))


OP3_SQL = """
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
s AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS nr FROM l WHERE trim(line) <> ''),
w AS (SELECT doc_id, nr, trim(line) || chr(10) || lead(trim(line)) OVER d || chr(10) || lead(trim(line), 2) OVER d AS win FROM s WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
o AS (SELECT doc_id, nr, row_number() OVER (PARTITION BY win ORDER BY doc_id, nr) AS nth FROM w WHERE win IS NOT NULL),
c AS (SELECT DISTINCT doc_id, nr + k AS nr FROM o, range(3) r(k) WHERE nth > 1),
j AS (SELECT l.doc_id, l.pos, l.line, s.nr IS NOT NULL AS solid, c.nr IS NOT NULL AS gone
      FROM l LEFT JOIN s ON l.doc_id = s.doc_id AND l.pos = s.pos LEFT JOIN c ON s.doc_id = c.doc_id AND s.nr = c.nr)
SELECT doc_id, coalesce(string_agg(CASE WHEN NOT gone THEN line END, chr(10) ORDER BY pos), '') AS text, sum(solid::INT)::BIGINT AS n_lines, sum(gone::INT)::BIGINT AS n_removed
FROM j GROUP BY doc_id
"""
