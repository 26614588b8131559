"""Reports over the validation audit log (JSON lines)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

AUDIT_SCHEMA = (
    "timestamp string, schema_name string, quarantine_file string, failed_rows bigint, total_rows bigint, "
    "rules_applied array<string>, failure_rate double, _corrupt_record string"
)

# Report thresholds.
RATE_TREND_PCT, VOLUME_TREND_PCT, ANOMALY_PCT = 10.0, 20.0, 50.0
MAX_RATE, MAX_SCHEMA_RATE, SPIKE_FACTOR = 0.05, 0.10, 2.0


def load_audit(spark: SparkSession, path: str, as_of: Column, days: int = 30) -> DataFrame:
    """Entries of the last ``days`` days before ``as_of``; malformed lines are left out.

    Stamps may be in any ISO form: with ``T`` or a blank, fractions of a second, or an offset.
    """
    rows = spark.read.schema(AUDIT_SCHEMA).option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    at = F.try_to_timestamp("timestamp")
    return (
        rows.withColumn("at", at)
        .filter(F.col("_corrupt_record").isNull() & F.col("at").isNotNull())
        .filter(F.col("at") >= as_of - F.make_interval(days=F.lit(days)))
        .drop("_corrupt_record")
    )


def daily_report(entries: DataFrame) -> DataFrame:
    """Totals, schemas and rules per day; entries are one per validation run, so days are small."""
    return entries.groupBy(F.to_date("at").alias("report_date")).agg(
        F.count("*").alias("validations"),
        F.sum("total_rows").alias("rows_validated"),
        F.sum("failed_rows").alias("failures"),
        F.coalesce(F.try_divide(F.sum("failed_rows").cast("double"), F.sum("total_rows")), F.lit(0.0)).alias("failure_rate"),
        F.array_join(F.array_sort(F.collect_set("schema_name")), ",").alias("schemas"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("rules_applied")))), ",").alias("rules"),
    )


def _change(now: Column, before: Column) -> Column:
    return F.when(before > 0, (now - before) / before * 100).otherwise(0.0)


def _trend(change: Column, limit: float) -> Column:
    return F.when(change > limit, "increasing").when(change < -limit, "decreasing").otherwise("stable")


def trends(report: DataFrame) -> DataFrame:
    """Failure rate and volume against the previous calendar day, for days that have one."""
    prev = report.select(
        F.date_add("report_date", 1).alias("report_date"), F.col("failure_rate").alias("_r"), F.col("rows_validated").cast("double").alias("_v")
    )
    both = report.join(prev, "report_date")
    rate = _change(F.col("failure_rate"), F.col("_r"))
    volume = _change(F.col("rows_validated").cast("double"), F.col("_v"))
    metrics = F.array(
        F.struct(
            F.lit("failure_rate").alias("metric"), F.col("failure_rate").alias("current_value"), F.col("_r").alias("previous_value"), rate.alias("change_pct"),
            _trend(rate, RATE_TREND_PCT).alias("trend"), (rate > ANOMALY_PCT).alias("is_anomaly"),
        ),
        F.struct(
            F.lit("validation_volume").alias("metric"), F.col("rows_validated").cast("double").alias("current_value"), F.col("_v").alias("previous_value"),
            volume.alias("change_pct"), _trend(volume, VOLUME_TREND_PCT).alias("trend"), (F.abs(volume) > ANOMALY_PCT).alias("is_anomaly"),
        ),
    )
    return both.select("report_date", F.inline(metrics))


def anomalies(entries: DataFrame) -> DataFrame:
    """Days with a high failure rate, schemas with one, and days with a spike in validations.

    The weekly average counts the seven days up to and including the day.
    """
    day = F.to_date("at").alias("report_date")
    per_schema = entries.groupBy(day, "schema_name").agg(F.sum("failed_rows").alias("f"), F.sum("total_rows").alias("t"), F.count("*").alias("n"))
    rate = F.coalesce(F.try_divide(F.col("f").cast("double"), F.col("t")), F.lit(0.0))
    schema_rate = per_schema.filter(rate > MAX_SCHEMA_RATE).select("report_date", F.lit("schema_rate").alias("kind"), "schema_name", rate.alias("value"))
    daily = per_schema.groupBy("report_date").agg(F.sum("f").alias("f"), F.sum("t").alias("t"), F.sum("n").alias("n"))
    high = daily.filter(rate > MAX_RATE).select("report_date", F.lit("high_rate").alias("kind"), F.lit("").alias("schema_name"), rate.alias("value"))
    # one row per day: the log's date range bounds this window
    week = Window.orderBy(F.unix_date("report_date")).rangeBetween(-6, 0)
    spike = (
        daily.withColumn("_w", F.sum("n").over(week))
        .filter((F.col("_w") > F.col("n")) & (F.col("n") > F.col("_w") / 7 * SPIKE_FACTOR))
        .select("report_date", F.lit("volume_spike").alias("kind"), F.lit("").alias("schema_name"), F.col("n").cast("double").alias("value"))
    )
    return high.unionByName(schema_rate).unionByName(spike)


def daily_series(entries: DataFrame) -> DataFrame:
    """Chart series: rows validated, failures and failure rate per day."""
    return entries.groupBy(F.to_date("at").alias("report_date")).agg(
        F.sum("total_rows").alias("volume"), F.sum("failed_rows").alias("failures"),
        F.coalesce(F.try_divide(F.sum("failed_rows").cast("double"), F.sum("total_rows")), F.lit(0.0)).alias("failure_rate"),
    )
