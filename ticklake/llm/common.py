"""Helpers the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.session import fresh_path

A_TO_Z = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: lost executors cost no recomputation."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def free(name: str, taken: list[str]) -> str:
    """``name`` with as many strokes in front as make it a name that ``taken`` does not have."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def keep_rows(docs: DataFrame, kept: DataFrame, key: str, content: Column) -> DataFrame:
    """Rows of ``docs``, all columns as they are, whose ``key`` (null counts as a value) and ``content`` are a row of
    ``kept``, which has these two columns.  Rows are told apart by both, as an id may stand on different texts."""
    known, text = free("kept_key", docs.columns), free("kept_content", docs.columns)
    own = kept.toDF(known, text).distinct()
    return docs.join(own, F.col(quoted(key)).eqNullSafe(F.col(known)) & (content == F.col(text)), "left_semi")
