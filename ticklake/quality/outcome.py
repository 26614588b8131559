"""What happens with a verdict: summary, gate, quarantine, audit, replay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.quality.rules import FLAGS


class NoRows(ValueError):
    """A step that must yield rows yielded none."""


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """``df`` itself, after checking that it has a row (at most one row is read)."""
    if df.isEmpty():
        raise NoRows(f"{what}: no rows")
    return df


def good_rows(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.size(FLAGS) == 0).drop(FLAGS)


def quarantine_rows(flagged: DataFrame, table: str, stamp: str, retry: Column | None = None) -> DataFrame:
    """Bad rows with their reasons; rule order is the order of the checks."""
    parts = {p: F.col(f"{FLAGS}.{p}") for p in ("message", "severity", "rule")}
    return flagged.filter(F.size(FLAGS) > 0).withColumns(
        {
            "error_messages": F.array_join(parts["message"], "; "),
            "error_types": F.array_join(F.array_distinct(parts["severity"]), ","),
            "rules": F.array_join(F.array_distinct(parts["rule"]), ","),
            "schema_name": F.lit(table),
            "quarantined_at": F.lit(stamp).cast("timestamp"),
            "retry_count": retry if retry is not None else F.lit(0),
        }
    ).drop(FLAGS)


SUMMARY_SCHEMA = "total_rows bigint, valid_rows bigint, failed_rows bigint, critical_failures bigint, warnings bigint"


def summary_columns() -> list[Column]:
    """Totals over flagged rows.  Every finding counts in ``critical_failures``, as published totals
    do; ``warnings`` says how many of them are warnings."""
    soft = F.size(F.filter(FLAGS, lambda v: v["severity"] == "warning"))
    return [
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.size(FLAGS) == 0).alias("valid_rows"),
        F.count_if(F.size(FLAGS) > 0).alias("failed_rows"),
        F.coalesce(F.sum(F.size(FLAGS)), F.lit(0)).cast("bigint").alias("critical_failures"),
        F.coalesce(F.sum(soft), F.lit(0)).cast("bigint").alias("warnings"),
    ]


def summary(flagged: DataFrame) -> DataFrame:
    return flagged.agg(*summary_columns())


def gate(result: DataFrame, max_rate: float = 0.05, any_error_fails: bool = False) -> DataFrame:
    """Verdict on a summary: too many failing rows, or any at all."""
    rate = F.coalesce(F.try_divide(F.col("failed_rows").cast("double"), F.col("total_rows")), F.lit(0.0))
    failed = (F.col("failed_rows") > 0) if any_error_fails else (rate > max_rate)
    return result.withColumns({"failure_rate": rate, "passed": ~failed})


def audit_row(result: DataFrame, table: str, rules: tuple[str, ...], quarantine_path: str, stamp: str) -> DataFrame:
    rate = F.coalesce(F.try_divide(F.col("failed_rows").cast("double"), F.col("total_rows")), F.lit(0.0))
    return result.select(
        F.lit(stamp).alias("timestamp"), F.lit(table).alias("schema_name"), F.lit(quarantine_path).alias("quarantine_file"), "failed_rows", "total_rows",
        F.array(*[F.lit(r) for r in rules]).alias("rules_applied"), rate.alias("failure_rate"),
    )


def replay(quarantined: DataFrame, fixes: DataFrame, key: str, table_columns: list[str]) -> DataFrame:
    """Quarantined rows with corrections applied, retry count raised; fixes are unique per key."""
    changed = [c for c in fixes.columns if c != key]
    fixed = fixes.select(key, *[F.col(c).alias(f"_f_{c}") for c in changed])
    out = quarantined.join(fixed, key, "left").withColumns({c: F.coalesce(f"_f_{c}", c) for c in changed})
    return out.select(*table_columns, (F.col("retry_count") + 1).alias("retry_count"))


def daily_quality(df: DataFrame, day: str, as_of: str, max_price: float = 1_000_000) -> DataFrame:
    """Completeness, validity, inconsistency and freshness per day."""
    cells = [c for c in df.columns]
    nulls = sum((F.col(c).isNull().cast("int") for c in cells), F.lit(0))
    invalid = (F.col("close") <= 0) | (F.col("close") > max_price)
    hours = (F.unix_seconds(F.lit(as_of).cast("timestamp")) - F.unix_seconds(F.col(day).cast("timestamp"))) / 3600
    return df.groupBy(day).agg(
        F.count("*").alias("rows"),
        ((1 - F.sum(nulls) / (F.count("*") * len(cells))) * 100).alias("completeness_pct"),
        F.count_if(invalid).alias("invalid_prices"),
        ((1 - F.count_if(invalid) / F.count("*")) * 100).alias("validity_pct"),
        F.count_if((F.col("turnover") == 0) & (F.col("volume") > 0)).alias("inconsistent"),
        F.max(hours).alias("freshness_hours"),
    )
