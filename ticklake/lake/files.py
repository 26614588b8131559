"""File-level upkeep: statistics, compaction of small files, expiry of old partitions."""

from __future__ import annotations

import math
import re
import uuid
from collections import deque
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticklake.functions.text import parse_date

MB = 1024 * 1024
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
#: most files, and about the most megabytes, that one task of a compaction writes
FILES_PER_TASK = 64
FILES_PER_TASK_MB = 128


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Data files below ``path`` as (file, bytes, partition); only listings are read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    )
    root = re.sub(r"^file:/*", "/", path).rstrip("/")
    relative = F.substring_index("path", f"{root}/", -1)
    return files.select(
        F.col("path").alias("file"), F.col("length").alias("bytes"), F.regexp_extract(relative, r"^(.*)/[^/]+$", 1).alias("partition")
    )


def dataset_statistics(spark: SparkSession, path: str) -> DataFrame:
    total = F.coalesce(F.sum("bytes"), F.lit(0))
    return list_files(spark, path).agg(
        F.count("*").alias("files"), total.alias("total_bytes"), (total / MB).alias("total_mb"),
        F.coalesce(F.try_divide(total / MB, F.count("*")), F.lit(0.0)).alias("avg_file_mb"),
    )


def compaction_plan(spark: SparkSession, path: str, target_mb: float, min_mb: float) -> DataFrame:
    """Partitions with at least two files of at most ``min_mb``, and the files they should become."""
    per = list_files(spark, path).groupBy("partition").agg(
        F.count("*").alias("files"), F.count_if(F.col("bytes") <= min_mb * MB).alias("small_files"), F.sum("bytes").alias("bytes")
    )
    target = F.greatest(F.ceil(F.col("bytes") / (target_mb * MB)), F.lit(1)).cast("int")
    return per.filter("small_files >= 2").withColumn("target_files", target)


def compact(spark: SparkSession, path: str, staging: str, target_mb: float = 128, min_mb: float = 32) -> DataFrame:
    """Rewrite the planned partitions as the planned number of files; returns the plan that was carried out.

    All partitions are rewritten by one job: rows are dealt to the files of their partition by hash, and a task writes
    one file after the other, up to ``FILES_PER_TASK`` small ones.  Partitioned data is written once, below a hidden
    folder of ``path``; when all new files are complete they replace the old ones folder by folder, so a job that dies
    loses nothing.  A folder without partitions is staged first.
    """
    compaction_plan(spark, path, target_mb, min_mb).write.mode("overwrite").parquet(f"{staging}/plan")
    plan = spark.read.parquet(f"{staging}/plan")
    data = spark.read.parquet(path)
    total = plan.agg(F.sum("target_files").alias("files")).first()["files"]
    if not total:
        return plan
    keys = _partition_columns(spark, path)
    # one row per partition: its first file number
    before = Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)
    wanted = plan.withColumn("_first", F.coalesce(F.sum("target_files").over(before), F.lit(0)))
    wanted = wanted.select(*[_folder_value(k).try_cast(data.schema[k].dataType).alias(f"_k_{k}") for k in keys], "target_files", "_first")
    chosen = _planned_rows(data, wanted, keys) if keys else data.join(F.broadcast(wanted))  # without keys the plan is one row
    file = F.col("_first") + F.pmod(F.xxhash64(*data.columns), F.col("target_files"))
    dealt = chosen.withColumn("_file", file.cast("int"))
    if keys:
        each = max(1, min(FILES_PER_TASK, int(FILES_PER_TASK_MB / target_mb)))
        dealt = dealt.withColumn("_task", (F.col("_file") / each).cast("int"))
        rows = dealt.repartitionById(math.ceil(total / each), "_task").select(*data.columns, "_file")
        hidden = f"{path}/.compaction-{uuid.uuid4().hex}"
        # nobody reads the hidden folder before the job is done, so tasks may put their files in place by themselves
        rows.write.option("mapreduce.fileoutputcommitter.algorithm.version", 2).partitionBy(*keys, "_file").parquet(f"{hidden}/written")
        _replace_folders(spark, path, hidden, len(keys))
    else:
        rows = dealt.repartitionById(int(total), "_file").select(*data.columns)
        rows.write.mode("overwrite").parquet(f"{staging}/data")
        spark.read.schema(data.schema).parquet(f"{staging}/data").write.mode("overwrite").parquet(path)
    return plan


def _replace_folders(spark: SparkSession, path: str, hidden: str, depth: int) -> None:
    """Put the files of ``hidden``/written/<partition>/_file=<n>/ in place of the partition's old ones; ``depth`` is the number
    of partition columns.

    The new files of every partition are first brought together in one folder each, then each old folder makes way for
    its new one.  Only listings and renames happen here, as in the commit of a write.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(hidden).getFileSystem(spark._jsc.hadoopConfiguration())
    run = uuid.uuid4().hex
    at = re.sub(r"([\\*?\[\]{}])", r"\\\1", f"{hidden}/written")
    # one glob: it lists folders inside the JVM and, unlike a listing of located files, asks for no file's owner
    found = hadoop.FileUtil.stat2Paths(fs.globStatus(hadoop.Path(at + "/*" * depth + "/_file=*/part-*")))
    names = (found[i].toString() for i in range(len(found)))

    def rename(old: str, new: str) -> None:
        if not fs.rename(hadoop.Path(old), hadoop.Path(new)):
            raise OSError(f"{old} could not be renamed to {new}")

    folders: set[str] = set()
    with ThreadPoolExecutor(16) as pool:
        moves = deque()
        for old in names:
            folder, number, name = re.search(r"/written(/.*)/_file=(\d+)/([^/]+)$", old).groups()
            if folder not in folders:
                folders.add(folder)
                fs.mkdirs(hadoop.Path(f"{hidden}/ready{folder}"))
            new = f"part-{int(number):05d}-{run}{name[name.index('.') :]}"
            moves.append(pool.submit(rename, old, f"{hidden}/ready{folder}/{new}"))
            if len(moves) > 1000:
                moves.popleft().result()
        for move in moves:
            move.result()
    for folder in sorted(folders):
        fs.delete(hadoop.Path(f"{path}{folder}"), True)
        rename(f"{hidden}/ready{folder}", f"{path}{folder}")
    fs.delete(hadoop.Path(hidden), True)


def _planned_rows(data: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the planned partitions, null ones included, with the columns of the plan.

    Partition values are compared as texts under plain equality: a null-safe comparison would keep Spark from pruning the
    partitions of the scan by the plan, and all of the data would be read to rewrite a few folders.
    """
    as_text = lambda c: F.coalesce(c.cast("string"), F.lit(NULL_PARTITION))
    same = reduce(lambda c, k: c & (as_text(data[k]) == as_text(wanted[f"_k_{k}"])), keys, F.lit(True))
    return data.join(wanted.filter("target_files > 0"), same)


def _folder_value(key: str) -> Column:
    """Value of ``key`` in a folder path, with its escapes undone."""
    raw = F.regexp_extract("partition", f"(?:^|/){key}=([^/]+)", 1)
    return F.nullif(F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))), F.lit(NULL_PARTITION))


def _partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Partition columns in folder order, read off one file's path."""
    one = list_files(spark, path).select("partition").limit(1).collect()
    return [p.split("=")[0] for p in one[0]["partition"].split("/") if "=" in p] if one else []


def partition_ages(spark: SparkSession, path: str, key: str, as_of: Column, formats=("yyyy-MM-dd",)) -> DataFrame:
    """Age in days of each ``key=value`` folder; -1 where the value is no date."""
    value = F.regexp_extract("partition", f"(?:^|/){key}=([^/]+)", 1)
    folders = list_files(spark, path).select("partition", value.alias("value")).filter("value <> ''")
    age = F.coalesce(F.datediff(as_of, parse_date(F.col("value"), formats)), F.lit(-1))
    folder = F.regexp_extract("partition", f"^((?:.*/)?{key}=[^/]+)", 1)
    return folders.select(folder.alias("folder"), "value", age.alias("age_days")).distinct()


def expired_partitions(ages: DataFrame, retention_days: int) -> DataFrame:
    """Folders strictly older than the retention."""
    return ages.filter(F.col("age_days") > retention_days)


def drop_expired(spark: SparkSession, path: str, key: str, as_of: Column, retention_days: int, dry_run: bool = True) -> DataFrame:
    """Expired folders; unless ``dry_run`` they are deleted through the Hadoop file system.

    Folder names come to the driver as a list: there is one per expired partition value, not per row or file.
    """
    old = expired_partitions(partition_ages(spark, path, key, as_of), retention_days)
    if dry_run:
        return old
    names = [r["folder"] for r in old.select("folder").collect()]
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for name in names:
        fs.delete(hadoop.Path(f"{path}/{name}"), True)
    return spark.createDataFrame([(n,) for n in names], "folder string")
