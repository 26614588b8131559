"""Column-set, type and evolution checks on schemas; no data is read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WIDENINGS = {("int", "bigint"), ("float", "double"), ("smallint", "int"), ("tinyint", "int")}


class SchemaMismatch(ValueError):
    """The columns are not the agreed ones."""


def column_diff(actual: list[str], expected: list[str]) -> tuple[list[str], list[str]]:
    """Columns that are missing and columns nobody expects."""
    return [c for c in expected if c not in actual], [c for c in actual if c not in expected]


def check_columns(actual: list[str], expected: list[str]) -> None:
    missing, extra = column_diff(actual, expected)
    if missing or extra:
        raise SchemaMismatch(f"missing columns {missing}, unexpected columns {extra}")


def schema_diff(old: T.StructType, new: T.StructType) -> list[tuple[str, str, bool]]:
    """(field, change, allowed) for every difference.

    Adding an optional field and widening a number are allowed; removing, retyping, or adding a
    required field is not.
    """
    before = {f.name: f for f in old.fields}
    after = {f.name: f for f in new.fields}
    out = []
    for name, f in before.items():
        if name not in after:
            out.append((name, "removed", False))
            continue
        a, b = f.dataType.simpleString(), after[name].dataType.simpleString()
        if a != b:
            out.append((name, f"{a} -> {b}", (a, b) in WIDENINGS))
        if f.nullable and not after[name].nullable:
            out.append((name, "became required", False))
    out += [(n, "added", f.nullable) for n, f in after.items() if n not in before]
    return out


def counted(df: DataFrame, labels: list[str], rows: list[tuple], counters: list[Column]) -> DataFrame:
    """``rows`` labelled by ``labels``, each with its counter; all counters come from one pass over ``df``."""
    spark = df.sparkSession
    if not rows:
        kinds = ", ".join(f"{c} string" for c in labels)
        return spark.createDataFrame([], f"{kinds}, n bigint")
    totals = df.agg(*[c.alias(f"n{i}") for i, c in enumerate(counters)])
    entries = [F.struct(*[F.lit(v).alias(k) for k, v in zip(labels, row)], F.col(f"n{i}").alias("n")) for i, row in enumerate(rows)]
    return totals.select(F.inline(F.array(*entries)))


def column_report(df: DataFrame, expected: list[str]) -> DataFrame:
    """Missing and unexpected columns; for an unexpected one how many cells it fills."""
    missing, extra = column_diff(df.columns, expected)
    rows = [("missing", c) for c in missing] + [("unexpected", c) for c in extra]
    counters = [F.count_if(F.lit(False)) for _ in missing] + [F.count(F.col(f"`{c}`")) for c in extra]
    return counted(df, ["problem", "column_name"], rows, counters)


def type_report(df: DataFrame, wrong: list[tuple[str, str, str]]) -> DataFrame:
    """Fields of another type than agreed, with the number of cells that cannot be read as agreed."""
    counters = []
    for name, agreed, _ in wrong:
        c = F.col(name)
        counters.append(F.count(c) if agreed == "absent" else F.count_if(c.isNotNull() & c.try_cast(agreed).isNull()))
    return counted(df, ["field", "agreed", "actual"], wrong, counters)


def evolution_report(old: DataFrame, new: DataFrame) -> DataFrame:
    """Differences between two versions of a dataset, with the rows of the new one that fill the field."""
    rows = schema_diff(old.schema, new.schema)
    counters = [F.count(F.col(n)) if n in new.columns else F.count_if(F.lit(False)) for n, _, _ in rows]
    return counted(new, ["field", "change", "allowed"], rows, counters)
