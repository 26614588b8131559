"""Partitioned Parquet and CSV writes."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ticklake import schemas
from ticklake.lake import runs
from ticklake.quality import outcome, rules
from ticklake.session import fresh_path

CODECS = ("snappy", "gzip", "zstd", "none")


def date_parts(df: DataFrame, date_col: str) -> DataFrame:
    """Add year, quarter, month and day of ``date_col``."""
    d = F.col(date_col)
    return df.withColumns({"year": F.year(d), "quarter": F.quarter(d), "month": F.month(d), "day": F.day(d)})


def write_dataset(
    df: DataFrame, path: str, partitions: list[str], codec: str = "zstd", rows_per_file: int = 0, sort_by: tuple[str, ...] = (), add: bool = False
) -> None:
    """Replace exactly the partitions present in ``df`` and leave all others; with ``add`` put the rows beside those there.

    The rebalance hint groups rows by partition before the write and lets the adaptive planner split
    a partition that is too large for one task, so a hot partition becomes several files and a cold
    one a single file.  Sorting inside files narrows their min/max statistics.
    """
    if codec not in CODECS:
        raise ValueError(f"codec must be one of {CODECS}")
    rows = df.hint("rebalance", *partitions) if partitions else df
    if sort_by:
        rows = rows.sortWithinPartitions(*partitions, *sort_by)
    writer = rows.write.mode("append" if add else "overwrite").option("partitionOverwriteMode", "dynamic").option("compression", codec)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(path)


def write_table(df: DataFrame, path: str, table: str, sort_by: tuple[str, ...] = ()) -> None:
    """Write in the agreed layout of ``table``; all dates of the frame in one job."""
    date_col, parts = schemas.LAYOUTS[table]
    have = df.columns
    needed = [p for p in parts if p in ("year", "quarter", "month", "day") and p not in have]
    rows = date_parts(df, date_col).select(*have, *needed) if needed else df
    write_dataset(rows, path, list(parts), sort_by=sort_by)


class ValidationFailed(ValueError):
    """The rows did not pass and the caller asked to stop."""


def write_checked(
    df: DataFrame, path: str, partitions: list[str], checks: list[rules.Check], table: str, quarantine_path: str, audit_path: str,
    stamp: str, fail: bool = False, keep_bad_rows: bool = False, run_id: str | None = None,
) -> dict[str, int]:
    """Validate, quarantine, audit, then write the rows that pass; returns the totals.

    Quarantine and audit of the run lie below ``run=<run_id>``, and its ledger row (below ``_runs`` of the audit) comes
    last.  A run that is in the ledger is not repeated; one that broke off, or that ``fail`` stopped, replaces what it
    wrote.  Without ``run_id`` every call is a run of its own.

    Totals are observed while the quarantine is written, so the table is read twice in all: once for
    the quarantine and once for the write.  Reasons are put together for failing rows only.  ``keep_bad_rows``
    also writes failing rows to the table.
    """
    spark = df.sparkSession
    run = runs.checked_id(run_id or uuid.uuid4().hex)
    done = runs.committed(spark, ledger_path(audit_path), run)
    if done:
        return {c: done[c] for c in runs.TOTALS}
    totals = _set_aside(df, checks, table, quarantine_path, audit_path, stamp, run)
    if fail and totals["failed_rows"]:
        runs.commit(spark, ledger_path(audit_path), run, table, totals, "stopped", stamp)
        raise ValidationFailed(f"{table}: {totals['failed_rows']} rows failed validation, see {quarantine_path}")
    write_dataset(df if keep_bad_rows else df.filter(~rules.breaks_any(checks)), path, partitions)
    runs.commit(spark, ledger_path(audit_path), run, table, totals, "stored", stamp)
    return totals


def ledger_path(audit_path: str) -> str:
    return f"{audit_path}/_runs"


def _set_aside(df: DataFrame, checks: list[rules.Check], table: str, quarantine_path: str, audit_path: str, stamp: str, run: str, retry: Column | None = None) -> dict[str, int]:
    """Write quarantine and audit of the run; returns the totals observed on the way."""
    seen, failed = Observation(), Observation()
    # every row passes the first observation, but only a failing one with its columns; no filter is pushed below it
    row = F.when(rules.breaks_any(checks), F.struct("*")).alias("_row")
    bad = df.select(row).observe(seen, F.count(F.lit(1)).alias("total_rows")).filter("_row IS NOT NULL").select("_row.*")
    flagged = rules.flag(bad, checks).observe(failed, *outcome.summary_columns())
    outcome.quarantine_rows(flagged, table, stamp, retry).write.mode("overwrite").parquet(f"{quarantine_path}/run={run}")
    n = seen.get["total_rows"]
    totals = {**failed.get, "total_rows": n, "valid_rows": n - failed.get["failed_rows"]}
    names = tuple(dict.fromkeys(c.rule for c in checks))
    result = df.sparkSession.createDataFrame([totals], outcome.SUMMARY_SCHEMA)
    outcome.audit_row(result, table, names, quarantine_path, stamp).write.mode("overwrite").json(f"{audit_path}/run={run}")
    return totals


def replay_run(
    spark: SparkSession, run_id: str, replay_id: str, fixes: DataFrame, key: str, path: str, partitions: list[str], checks: list[rules.Check], table: str,
    quarantine_path: str, audit_path: str, stamp: str,
) -> dict[str, int]:
    """Correct the quarantined rows of a run, validate them again and bring those that pass into the table.

    The replay is a run of its own, ``<run_id>~<replay_id>``: one that is in the ledger is not repeated.  Rows that fail
    again are quarantined under it with a raised retry count, and it supersedes the quarantine of the run it replays.
    Rows are put into the table by ``key`` (a stored row with that key is replaced), so a replay that broke off after
    the table was written leaves no second copy.  Only partitions that corrected rows fall into are written, and of these
    only such with a row to replace as a whole.
    """
    run = runs.checked_id(f"{run_id}~{replay_id}")
    book = ledger_path(audit_path)
    done = runs.committed(spark, book, run)
    if done:
        return {c: done[c] for c in runs.TOTALS}
    if runs.committed(spark, book, runs.checked_id(run_id)) is None:
        raise ValueError(f"run {run_id} has not been committed")
    stored = spark.read.parquet(path)
    bad = spark.read.parquet(f"{quarantine_path}/run={run_id}")
    again = outcome.replay(bad, fixes, key, stored.columns)
    retry = F.col("retry_count")
    totals = _set_aside(again, checks, table, quarantine_path, audit_path, stamp, run, retry)
    accepted = again.filter(~rules.breaks_any(checks)).select(*stored.columns)
    # staged first, as the table is read and written
    staged = fresh_path(spark, "replay")
    accepted.write.parquet(f"{staged}/accepted")
    accepted = spark.read.schema(accepted.schema).parquet(f"{staged}/accepted")
    if not accepted.isEmpty():
        _put(spark, stored, accepted, key, path, partitions, staged)
    runs.commit(spark, book, run, table, totals, "stored", stamp, replays=run_id)
    return totals


def _put(spark: SparkSession, stored: DataFrame, accepted: DataFrame, key: str, path: str, partitions: list[str], staged: str) -> None:
    """Bring ``accepted`` into the table: partitions that hold one of their keys are written again without the rows
    they replace, in the others the rows are added.  Only the keys of the table are read to tell them apart."""

    def within(rows: DataFrame, places: DataFrame, how: str) -> DataFrame:
        same = [rows[p].eqNullSafe(places[p]) for p in partitions]
        return rows.join(places, reduce(lambda a, b: a & b, same, F.lit(True)), how)

    keys = accepted.select(key)
    hit = accepted.select(*partitions).distinct()
    held = within(stored.select(key, *partitions), hit, "left_semi") if partitions else stored.select(key)
    held.join(keys, key, "left_semi").select(*partitions, F.lit(True).alias("_held")).distinct().write.parquet(f"{staged}/held")
    held = spark.read.parquet(f"{staged}/held")  # a row a partition
    fresh = accepted
    if not held.isEmpty():
        old, again = (within(stored, held, "left_semi"), within(accepted, held, "left_semi")) if partitions else (stored, accepted)
        merged = old.join(keys, key, "left_anti").select(*stored.columns).unionByName(again)
        merged.write.parquet(f"{staged}/merged")
        write_dataset(spark.read.schema(merged.schema).parquet(f"{staged}/merged"), path, partitions)
        fresh = within(accepted, held, "left_anti") if partitions else accepted.limit(0)
    if not fresh.isEmpty():
        write_dataset(fresh, path, partitions, add=True)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def within_ttl(df: DataFrame, table: str, as_of: Column) -> DataFrame:
    """Rows younger than the table's retention."""
    date_col, years = schemas.RETENTION_YEARS[table]
    return df.filter(F.col(date_col) >= F.add_months(as_of, -12 * years))


def write_features(df: DataFrame, path: str) -> None:
    """One folder per feature version and year; a version only ever replaces its own folders."""
    rows = df.withColumn("year", F.year("trade_date"))
    write_dataset(rows, path, ["feature_version", "year"], sort_by=("symbol", "trade_date"))


def prepare_for_serving(df: DataFrame, required: list[str], date_cols: tuple[str, ...] = (), ms_cols: tuple[str, ...] = ()) -> DataFrame:
    """Serving names, epoch milliseconds as timestamps, ISO text as dates; required columns must exist."""
    from ticklake.quality.shape import column_diff
    from ticklake.sources.feeds import to_serving_names

    out = to_serving_names(df)
    missing, _ = column_diff(out.columns, required)
    if missing:
        raise ValueError(f"columns required for the load are missing: {missing}")
    out = out.withColumns({c: F.timestamp_millis(F.col(c)) for c in ms_cols if c in out.columns})
    return out.withColumns({c: F.try_to_date(F.col(c), "yyyy-MM-dd") for c in date_cols if c in out.columns})


def load_sample(loaded: DataFrame, order: list[str], rows: int = 5) -> DataFrame:
    """The first rows of a load in a stated order."""
    return loaded.orderBy(*order).limit(rows)


def verify_load(loaded: DataFrame, expected: DataFrame) -> DataFrame:
    """Actual and expected row counts in one row."""
    want = expected.agg(F.count("*")).scalar()
    return loaded.agg(F.count("*").alias("actual")).select("actual", want.alias("expected")).withColumn("complete", F.col("actual") == F.col("expected"))
