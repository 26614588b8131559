"""Parquet and CSV datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_lake(spark: SparkSession, path: str, infer_partitions: bool = True) -> DataFrame:
    """File, folder or glob.  Without partition inference every file below is read as it is."""
    reader = spark.read
    if not infer_partitions:
        reader = reader.option("recursiveFileLookup", True)
    return reader.parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table as it lies; Spark splits its files by itself."""
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a declared schema: no inference pass over the data."""
    return spark.read.schema(schema).option("header", True).csv(path)
