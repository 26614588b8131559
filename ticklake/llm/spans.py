"""Spans of regular expressions, as DataFrame expressions.

Positions are code points, the end is exclusive.  The text between the matches (``split``) and the matches
themselves come from the same left-to-right scan, so their lengths add up to the places of the matches.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<kind:string,start:int,end:int,value:string,before:string,after:string>"
CONTEXT = 40


def no_spans() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def matches(text: Column, pattern: str, kind: str, needs: Column | None = None) -> Column:
    """Array of the leftmost non-overlapping matches: kind, start, end, value, and the text before (at most ``CONTEXT``
    code points, back to the previous match) and the one after.  Empty for a null text.  ``needs`` is a cheap test that
    every text with a match passes; the others are not scanned."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.zip_with(
        F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, v: F.struct(g.alias("gap"), v.alias("value"))), F.slice(gaps, 2, F.size(found)),
        lambda p, n: F.struct(p["gap"].alias("gap"), p["value"].alias("value"), F.left(n, F.lit(1)).alias("after")),
    )

    def step(a: Column, x: Column) -> Column:
        first = a["at"] + F.length(x["gap"])
        end = first + F.length(x["value"])
        span = F.struct(
            F.lit(kind).alias("kind"), first.alias("start"), end.alias("end"), x["value"].alias("value"), F.right(x["gap"], F.lit(CONTEXT)).alias("before"), x["after"].alias("after")
        )
        return F.struct(end.alias("at"), F.array_append(a["out"], span).alias("out"))

    spans = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), no_spans().alias("out")), step, lambda a: a["out"])
    there = text.rlike(pattern) if needs is None else needs & text.rlike(pattern)
    return F.when(text.isNotNull() & there, spans).otherwise(no_spans())


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(number)
    places = F.sequence(F.lit(1), n)

    def add(total: Column, i: Column) -> Column:
        d = F.ascii(F.substr(number, i, F.lit(1))) - 48
        twice = 2 * d
        return total + F.when((n - i) % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    return F.aggregate(places, F.lit(0), add) % 10 == 0
