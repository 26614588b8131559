"""Runs: what one job wrote, made visible by one ledger row, so that a repeated job changes nothing.

Everything a run writes beside the table lies below ``run=<id>`` and is replaced when the run is repeated.  The
ledger row comes last.  Readers take the rows of committed runs only; a run that replays another one supersedes its
quarantine.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.session import path_exists

TOTALS = ("total_rows", "valid_rows", "failed_rows", "critical_failures", "warnings")
LEDGER_SCHEMA = "run string, replays string, schema_name string, outcome string, committed_at string, " + ", ".join(f"{c} bigint" for c in TOTALS)


def checked_id(run: str) -> str:
    """``run`` itself, if it can name a folder."""
    if not re.fullmatch(r"[A-Za-z0-9._~-]{1,120}", run):
        raise ValueError(f"a run id holds letters, digits and . _ ~ - only: {run!r}")
    return run


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """One row a committed run."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).option("recursiveFileLookup", True).parquet(path)


def committed(spark: SparkSession, path: str, run: str) -> dict | None:
    """The ledger row of a run whose rows all went through, None where it has to run (again)."""
    if not path_exists(spark, f"{path}/{run}/_SUCCESS"):
        return None
    row = spark.read.schema(LEDGER_SCHEMA).parquet(f"{path}/{run}").first()
    return row.asDict() if row and row["outcome"] == "stored" else None


def commit(spark: SparkSession, path: str, run: str, table: str, totals: dict[str, int], outcome: str, stamp: str, replays: str | None = None) -> None:
    """Write the ledger row; a repeated run replaces its own."""
    row = {"run": run, "replays": replays, "schema_name": table, "outcome": outcome, "committed_at": stamp, **{c: totals[c] for c in TOTALS}}
    spark.createDataFrame([row], LEDGER_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/{run}")


def visible(rows: DataFrame, ledger_rows: DataFrame) -> DataFrame:
    """Rows (with their ``run``) of runs that are in the ledger."""
    return rows.join(ledger_rows.select("run"), "run", "left_semi")


def still_open(quarantine: DataFrame, ledger_rows: DataFrame) -> DataFrame:
    """Quarantined rows of committed runs that no finished replay has taken up."""
    taken = ledger_rows.where("outcome = 'stored' and replays is not null").select(F.col("replays").alias("run")).distinct()
    return visible(quarantine, ledger_rows).join(taken, "run", "left_anti")
