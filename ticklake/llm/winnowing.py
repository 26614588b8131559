"""Document fingerprints by winnowing, as DataFrame expressions on each row.

A text becomes tokens (runs of visible characters, a long run in pieces of ``RUN`` characters, every character of a
script written without blanks by itself), every token a 64-bit hash, and ``GRAM`` neighbouring hashes one gram hash, rolled over the text.  Of every ``WINDOW`` neighbouring
grams the smallest is selected, the right-most one on ties; a selected gram is written once, with its position.
Two texts that share a run of ``WINDOW + GRAM - 1`` tokens share a selected gram.  Nothing is shuffled to
fingerprint, and a text's work is linear in its length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticklake.llm.common import cut, documents, text_or_empty

GRAM = 4
WINDOW = 8
RUN = 24
POSITION_BITS = 26  # tokens of one text that can be told apart: 67 million


#: scripts written without blanks between words
UNSPACED = "".join(rf"\p{{Is{s}}}" for s in ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar"))


#: every character of these scripts, and others, from the first block of them on
MAY_BE_UNSPACED = r"[\x{0E00}-\x{10FFFF}]"


def token_hashes(text: Column) -> Column:
    extract = lambda pattern: F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # seven script classes on every character are half of the cost: only texts that may hold such characters pay it
    odd = (F.octet_length(text) > F.length(text)) & text.rlike(MAY_BE_UNSPACED)
    plain = extract(f"[^ \t\n\r\x0b\f]{{1,{RUN}}}")
    tokens = F.when(odd, extract(f"[{UNSPACED}]|[^ \t\n\r\x0b\f{UNSPACED}]{{1,{RUN}}}")).otherwise(plain)
    return F.transform(tokens, lambda w: F.xxhash64(w))


def with_fingerprint(df: DataFrame, text: Column, name: str, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``df`` with ``name``: struct of ``positions`` and ``hashes`` of the selected grams, in order of position.

    A text with fewer than ``gram`` tokens is one gram of what it has; one without tokens, null or empty, has
    empty arrays.  Equal texts have equal fingerprints.
    """
    h, g, m, p = (f"_{name}_{x}" for x in ("tokens", "grams", "least", "at"))
    df = df.withColumn(h, token_hashes(text))
    many = F.greatest(F.size(h) - (gram - 1), F.least(F.size(h), F.lit(1)))
    at = lambda i, k: F.get(F.col(h), i + F.lit(k))  # noqa: E731  null beyond the end
    rolled = F.transform(F.sequence(F.lit(0), many - 1), lambda i: F.xxhash64(*[at(i, k) for k in range(gram)]))
    df = df.withColumn(g, F.when(many > 0, rolled).otherwise(F.array().cast("array<bigint>")))
    # hash above, distance from the end below: the smallest number is the smallest hash, right-most on ties
    mask = (1 << POSITION_BITS) - 1
    df = df.withColumn(m, F.transform(g, lambda x, i: F.shiftleft(F.shiftright(x, POSITION_BITS), POSITION_BITS).bitwiseOR(F.lit(mask) - i.cast("long"))))
    # minima of 2, 4, 8 … neighbours, then of the window as two such runs; ``least`` passes over what is beyond the end
    doubled = lambda name, by: F.transform(F.col(name), lambda x, i: F.least(x, F.get(F.col(name), i + F.lit(by))))
    width, steps = 1, []
    while width < window:
        step = min(width, window - width)
        steps.append(f"{m}_{len(steps)}")
        df = df.withColumn(steps[-1], doubled(steps[-2] if len(steps) > 1 else m, step))
        width += step
    windows = F.greatest(F.size(g) - (window - 1), F.least(F.size(g), F.lit(1)))
    least = F.slice(steps[-1] if steps else m, 1, windows)
    df = df.withColumn(p, F.transform(F.array_distinct(least), lambda x: (F.lit(mask) - x.bitwiseAND(F.lit(mask))).cast("int")))
    positions = F.coalesce(F.col(p), F.array().cast("array<int>"))
    hashes = F.transform(positions, lambda p: F.get(F.col(g), p))
    return df.withColumn(name, F.struct(positions.alias("positions"), hashes.alias("hashes"))).drop(h, g, m, p, *steps)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard of the hashes of two fingerprints; 1 for two empty ones, 0 for one."""
    x, y = a.getField("hashes"), b.getField("hashes")
    union = F.size(F.array_union(x, y))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(x, y)) / union)


def written(fingerprint: Column) -> Column:
    """``hash@position`` in hexadecimal and decimal, comma-joined."""
    one = lambda h, p: F.concat(F.lower(F.hex(h)), F.lit("@"), p.cast("string"))
    return F.array_join(F.zip_with(fingerprint.getField("hashes"), fingerprint.getField("positions"), one), ",")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``id_col``, ``n_chars`` and ``fingerprint`` (struct of positions and hashes) of every row; null ids and repeated rows
    are rows like others, further columns are not read, an empty table gives an empty result."""
    rows = docs.select(F.col(id_col), text_or_empty(text_col).alias("_text"))
    return with_fingerprint(rows, F.col("_text"), "fingerprint", gram, window).select(id_col, F.length("_text").cast("long").alias("n_chars"), "fingerprint")


RANGE_ROWS = 2048
MOST_RANGES = 16_384
DRAWN = 20  # sampled rows for each range


def place(id_col: str, order: list[str]) -> Column:
    """A text that sorts like the rows and differs between any two: by descending id, null ids last, then by the first
    bytes of the first column of ``order``, a hash of all of them, and the row."""
    key = F.col(id_col).cast("long")
    wide = lambda x: F.lpad(F.hex(x), 16, "0")
    down = F.coalesce(F.bitwise_not(key).bitwiseXOR(F.lit(-(1 << 63))), F.lit(0).cast("long"))  # the lowest id has the highest digits
    begins = F.rpad(F.hex(F.substring(F.coalesce(F.col(order[0]).cast("string"), F.lit("")).cast("binary"), 1, 8)), 16, "0")
    return F.concat(F.when(key.isNull(), "1").otherwise("0"), wide(down), begins, wide(F.xxhash64(*order)), wide(F.xxhash64(F.monotonically_increasing_id())))


def range_of(key: Column, bounds: list[str]) -> Column:
    """How many of the sorted ``bounds`` are not above ``key``, by halving."""
    if not bounds:
        return F.lit(0)
    listed = F.split(F.lit(",".join(bounds)), ",")
    steps = F.sequence(F.lit(1), F.lit(len(bounds).bit_length()))

    def halve(s: Column, _: Column) -> Column:
        mid = F.shiftright(s["lo"] + s["hi"], 1)
        above = F.coalesce(F.get(listed, mid) > key, F.lit(True))
        return F.struct(F.when(above, s["lo"]).otherwise(mid + 1).alias("lo"), F.when(above, mid).otherwise(s["hi"]).alias("hi"))

    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi")), halve, lambda s: s["lo"])


def with_next(rows: DataFrame, id_col: str, columns: list[str], order: list[str], made: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``rows`` with ``next_<column>`` of the next row by descending id; after the last row comes the first.

    ``made`` adds columns to the rows, which may be among ``columns``: once a row, after the shuffle, so that they are
    not shuffled.

    Rows are cut by rank into ranges of about ``RANGE_ROWS`` rows, more in tables of over 30 million rows, where
    ``MOST_RANGES`` ranges are made; the bounds are quantiles of a sample of the rows' places, so neither gaps between
    ids nor rows with the same or no id fill a range.  A range is one window.  Its last row is followed by the first
    row of the next range that has rows; a copy of that one row is placed below it.  Rows with the same id follow
    each other by the first eight bytes of ``order``, then by its hash; null ids come after all others.
    """
    n = rows.count()
    ranges = min(MOST_RANGES, -(-n // RANGE_ROWS))
    drawn = rows.select(place(id_col, order).alias("key"), F.rand(7).alias("r")).where(F.col("r") < min(1.0, DRAWN * ranges / max(1, n)))
    # at most some 330,000 short texts
    keys = sorted(r["key"] for r in drawn.select("key").collect()) if ranges > 1 else []
    bounds = [keys[k * len(keys) // ranges] for k in range(1, ranges)] if keys else []
    placed = rows.withColumn("_key", place(id_col, order))
    # written, as the place of a row must be the same wherever it is read below
    tagged = cut(placed.withColumn("_range", range_of(F.col("_key"), bounds)), "ranges")
    # the first row of every range: at most MOST_RANGES rows
    heads = tagged.groupBy("_range").agg(F.min("_key").alias("_head"))
    every = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # its copy goes to the range before, that of the first range to the last
    heads = heads.select("_range", "_head", F.coalesce(F.lag("_range").over(Window.orderBy("_range")), F.last("_range").over(every)).alias("_goes"))
    first = tagged.join(F.broadcast(heads), "_range").where(F.col("_key") == F.col("_head"))
    copies = first.select(*rows.columns, "_key", F.col("_goes").alias("_range"), F.lit(1).alias("_copy"))
    both = tagged.withColumn("_copy", F.lit(0)).unionByName(copies)
    if made:
        both = made(both.repartition("_range").sortWithinPartitions("_range", "_copy", "_key"))
    inside = Window.partitionBy("_range").orderBy("_copy", "_key")
    both = both.withColumns({f"next_{c}": F.lead(c).over(inside) for c in columns})
    return both.where("_copy = 0").drop("_range", "_key", "_copy")


def op10_winnowing(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likeness."""
    rows = documents(spark, sf_dir).select("doc_id", text_or_empty().alias("text"))
    rows = with_next(rows, "doc_id", ["text", "fp"], ["text"], lambda both: with_fingerprint(both, F.col("text"), "fp"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left("text", n - half), F.left("next_text", half))
    rows = with_fingerprint(rows.withColumn("edited", edited), F.col("edited"), "efp")
    return rows.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        written(F.col("fp")).alias("fingerprint"), written(F.col("efp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("efp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
