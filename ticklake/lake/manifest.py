"""Idempotent writes: a manifest of what was written, checked against the data itself."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.lake.write import write_dataset
from ticklake.session import path_exists

MANIFEST_SCHEMA = "dataset string, key string, n_rows bigint, content_hash string, written_at timestamp"


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count and an order-free content hash: the sum of row hashes, which merges map-side."""
    cols = sorted(df.columns)
    total = F.sum(F.xxhash64(*[F.col(c) for c in cols]).cast("decimal(38,0)"))
    return df.agg(F.count("*").alias("n_rows"), F.coalesce(total, F.lit(0)).cast("string").alias("content_hash"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path)


def is_complete(spark: SparkSession, manifest_path: str, dataset: str, key: str, data_path: str) -> bool:
    """Whether the last manifest row for the key still describes the stored data.

    Data that is missing or altered does not count; a row for zero rows counts without data.
    """
    mine = read_manifest(spark, manifest_path).filter((F.col("dataset") == dataset) & (F.col("key") == key))
    row = mine.orderBy(F.desc("written_at")).limit(1).collect()
    if not row:
        return False
    if row[0]["n_rows"] == 0:
        return True
    try:
        now = fingerprint(spark.read.parquet(data_path)).first()
    except AnalysisException:
        return False
    return (now["n_rows"], now["content_hash"]) == (row[0]["n_rows"], row[0]["content_hash"])


def write_once(df: DataFrame, dataset: str, key: str, data_path: str, manifest_path: str, stamp: str) -> str:
    """Write unless the manifest and the data agree it is done; returns 'skipped' or 'written'.

    The data folder belongs to one (dataset, key) and is replaced whole, so a retry cannot duplicate.
    """
    spark = df.sparkSession
    if is_complete(spark, manifest_path, dataset, key, data_path):
        return "skipped"
    write_dataset(df, data_path, [])
    mark = fingerprint(spark.read.parquet(data_path)).select(
        F.lit(dataset).alias("dataset"), F.lit(key).alias("key"), "n_rows", "content_hash", F.lit(stamp).cast("timestamp").alias("written_at")
    )
    mark.write.mode("append").parquet(manifest_path)
    return "written"


def describe_dataset(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One row: schema, files, bytes and rows of a dataset.  Row counts come from Parquet footers."""
    from ticklake.lake.files import dataset_statistics

    data = spark.read.parquet(path)
    rows = data.agg(F.count("*")).scalar()
    return dataset_statistics(spark, path).select(
        F.lit(name).alias("dataset"), F.lit(data.schema.json()).alias("schema_json"), "files", "total_bytes", rows.alias("n_rows")
    )
