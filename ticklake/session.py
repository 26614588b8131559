"""Session construction and the shared working folder.

The working folder is the one the cluster names in ``spark.checkpoint.dir``.  Only a local
master without that setting falls back to a fresh temporary folder.
"""

from __future__ import annotations

import math
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

#: rows that one task of ``dealt`` may get
ROWS_PER_TASK = 500_000


def build_session(cores: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """Local session for tests and bench; on a cluster the submitter supplies the session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ticklake")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
        .config("spark.driver.memory", "16g")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, read from ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    return _local_dir()


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="ticklake-")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/ticklake/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below the shared folder and read from there, for rows that are dear to build and read several times."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, *keys: str, rows: int = 0) -> DataFrame:
    """``df`` by ``keys`` in as many tasks as the session shuffles into, more where ``rows`` ask for it.

    The adaptive planner merges partitions by the bytes of one shuffle; a stage that reads it several times, or holds
    far more in memory than was shuffled, is left with a few large tasks.  It keeps a number that is stated.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(tasks, math.ceil(rows / ROWS_PER_TASK)), *keys)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether something is stored there; a damaged folder exists and raises when it is read."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)
