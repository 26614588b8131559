"""SNK: writes, idempotency, compaction, retention and backfill, checked on what was stored."""

import contextlib

from pyspark.sql import functions as F

from ticklake import schemas
from ticklake.bridge import with_sql
from ticklake.functions.rounding import r4, sql4
from ticklake.lake import files, manifest, runs
from ticklake.lake import write as lw
from ticklake.operators.indicators import features
from ticklake.plans.quality import QUARANTINE_RULES, SETTINGS, STAMP, rule_sql
from ticklake.plans.registry import query
from ticklake.plans.windows import STAMP_MS
from ticklake.quality import rules
from ticklake.session import fresh_path
from ticklake.sources.lake import read_lake

CLOSE_SQL = f"SELECT symbol, trade_date, {sql4('close')} AS close FROM ohlc"


def bars(m):
    return m.closes.withColumns({"close": r4("close"), "year": F.year("trade_date")})


@query("snk01_partition_overwrite", with_sql("ohlc", body="SELECT year(trade_date) AS year, CASE WHEN year(trade_date) = 1997 THEN 'second' ELSE 'first' END AS run, count(*) AS n FROM ohlc GROUP BY 1, 2"))
def _(m):
    """A second write of one year replaces that year and nothing else."""
    path = fresh_path(m.spark, "bars")
    lw.write_dataset(bars(m).withColumn("run", F.lit("first")), path, ["year"], rows_per_file=5000, sort_by=("symbol",))
    lw.write_dataset(bars(m).filter("year = 1997").withColumn("run", F.lit("second")), path, ["year"], codec="gzip")
    return read_lake(m.spark, path).groupBy(F.col("year").cast("bigint").alias("year"), "run").agg(F.count("*").alias("n"))


@query(
    "snk02_validated_write",
    with_sql("dirty", body=f"SELECT CASE WHEN b.event_id IS NULL THEN 'stored' ELSE 'quarantined' END AS place, count(*) AS n FROM dirty d LEFT JOIN (SELECT DISTINCT event_id FROM ({rule_sql(QUARANTINE_RULES)})) b ON d.event_id = b.event_id GROUP BY 1"),
)
def _(m):
    """The run is repeated: nothing is doubled."""
    base = fresh_path(m.spark, "checked")
    rows = m.dirty.withColumn("year", F.year("trade_date"))
    checks = rules.checks_for(m.dirty, SETTINGS, QUARANTINE_RULES)
    for _ in range(2):
        lw.write_checked(rows, f"{base}/data", ["year"], checks, "normalized_equity_ohlc", f"{base}/quarantine", f"{base}/audit", STAMP, run_id="day-1")
    stored = read_lake(m.spark, f"{base}/data").select(F.lit("stored").alias("place"))
    book = runs.ledger(m.spark, lw.ledger_path(f"{base}/audit"))
    bad = runs.visible(read_lake(m.spark, f"{base}/quarantine"), book).select(F.lit("quarantined").alias("place"))
    return stored.unionByName(bad).groupBy("place").agg(F.count("*").alias("n"))


@query("snk03_table_layout", with_sql("ohlc", body=f"SELECT symbol, {sql4('close')} AS close, CAST(year(trade_date) AS INTEGER) AS year, CAST(month(trade_date) AS INTEGER) AS month, CAST(day(trade_date) AS INTEGER) AS day FROM ohlc"))
def _(m):
    """All days in one job, one folder per day."""
    path = fresh_path(m.spark, "daily")
    lw.write_table(m.closes, path, "normalized_equity_ohlc", sort_by=("symbol",))
    return read_lake(m.spark, path).select("symbol", r4("close").alias("close"), "year", "month", "day")


@query("snk04_deal_layout", with_sql("deals", body="SELECT deal_type, CAST(year(deal_date) AS INTEGER) AS year, CAST(month(deal_date) AS INTEGER) AS month, count(*) AS n FROM deals GROUP BY 1, 2, 3"))
def _(m):
    path = fresh_path(m.spark, "deals")
    lw.write_table(m.deals, path, "bulk_block_deals", sort_by=("symbol",))
    return read_lake(m.spark, path).groupBy("deal_type", "year", "month").agg(F.count("*").alias("n"))


@query("snk04_actions_layout", with_sql("ca", body="SELECT CAST(year(ex_date) AS INTEGER) AS year, action_type, count(*) AS n FROM ca GROUP BY 1, 2"))
def _(m):
    path = fresh_path(m.spark, "actions")
    lw.write_table(m.ca, path, "corporate_actions", sort_by=("symbol",))
    return read_lake(m.spark, path).groupBy("year", "action_type").agg(F.count("*").alias("n"))


@query("snk04_constituent_layout", with_sql("constituents", body="SELECT index_name, CAST(year(effective_date) AS INTEGER) AS year, CAST(month(effective_date) AS INTEGER) AS month, CAST(day(effective_date) AS INTEGER) AS day, count(*) AS n FROM constituents GROUP BY ALL"))
def _(m):
    path = fresh_path(m.spark, "constituents")
    lw.write_table(m.constituents, path, "index_constituent", sort_by=("symbol",))
    return read_lake(m.spark, path).groupBy("index_name", "year", "month", "day").agg(F.count("*").alias("n"))


@query("snk04_chain_layout", "SELECT DATE '2024-01-01' + CAST(p_partkey % 5 AS INTEGER) AS date, p_brand AS symbol, count(*) AS n, CAST(sum(p_size) AS BIGINT) AS strikes FROM part GROUP BY 1, 2")
def _(m):
    """One folder per day and underlying."""
    path = fresh_path(m.spark, "chain")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("p_partkey") % 5).cast("int"))
    rows = m.table("part").select(day.alias("date"), F.col("p_brand").alias("symbol"), F.col("p_size").cast("bigint").alias("strike"))
    lw.write_table(rows, path, "option_chain", sort_by=("strike",))
    return read_lake(m.spark, path).groupBy("date", "symbol").agg(F.count("*").alias("n"), F.sum("strike").alias("strikes"))


@query("snk04_shareholding_layout", with_sql("shareholding", body="SELECT symbol, year, quarter, promoter FROM shareholding"))
def _(m):
    path = fresh_path(m.spark, "shareholding")
    lw.write_table(m.shareholding, path, "shareholding_pattern", sort_by=("symbol",))
    return read_lake(m.spark, path).select("symbol", "year", "quarter", "promoter")


@query("snk05_compaction", with_sql("ohlc", body="SELECT CAST(year(trade_date) AS INTEGER) AS year, count(*) AS n, true AS as_planned FROM ohlc GROUP BY 1"))
def _(m):
    path = fresh_path(m.spark, "fragmented")
    bars(m).repartition(6).write.partitionBy("year").parquet(path)
    plan = files.compact(m.spark, path, fresh_path(m.spark, "compaction"), target_mb=0.004)
    after = files.list_files(m.spark, path).groupBy("partition").agg(F.count("*").alias("after"))
    shrunk = plan.join(after, "partition").select(
        F.regexp_extract("partition", r"year=(\d+)", 1).cast("int").alias("year"), (F.col("after") == F.col("target_files")).alias("as_planned")
    )
    rows = read_lake(m.spark, path).groupBy("year").agg(F.count("*").alias("n"))
    return rows.join(shrunk, "year", "left").select("year", "n", "as_planned")


@query("snk05_compaction_dry_run", with_sql("ohlc", body="SELECT 'year=' || year(trade_date) AS partition, CAST(1 AS INTEGER) AS target_files, true AS many_small FROM ohlc GROUP BY 1"))
def _(m):
    path = fresh_path(m.spark, "fragmented")
    bars(m).repartition(6).write.partitionBy("year").parquet(path)
    plan = files.compaction_plan(m.spark, path, target_mb=128, min_mb=32)
    return plan.select("partition", "target_files", (F.col("small_files") >= 2).alias("many_small"))


@query("snk06_dataset_statistics", with_sql("ohlc", body="SELECT count(DISTINCT year(trade_date)) AS files, true AS has_bytes FROM ohlc"))
def _(m):
    path = fresh_path(m.spark, "stats")
    bars(m).repartition("year").write.partitionBy("year").parquet(path)
    return files.dataset_statistics(m.spark, path).select("files", ((F.col("total_bytes") > 0) & (F.col("avg_file_mb") > 0)).alias("has_bytes"))


MONTHS = "'date=' || strftime(date_trunc('month', trade_date), '%Y-%m-%d')"


def monthly_dataset(m):
    path = fresh_path(m.spark, "monthly")
    rows = m.closes.withColumn("date", F.date_format(F.trunc("trade_date", "MM"), "yyyy-MM-dd"))
    odd = rows.filter("symbol = 'S1'").withColumn("date", F.lit("undated"))
    lw.write_dataset(rows.unionByName(odd), path, ["date"])
    return path


@query("snk07_partition_ages", with_sql("ohlc", body=f"SELECT DISTINCT {MONTHS} AS folder, CAST(DATE '2002-01-01' - CAST(date_trunc('month', trade_date) AS DATE) AS INTEGER) AS age_days FROM ohlc UNION ALL SELECT 'date=undated', -1"))
def _(m):
    as_of = F.lit("2002-01-01").cast("date")
    return files.partition_ages(m.spark, monthly_dataset(m), "date", as_of).select("folder", "age_days")


@query("snk07_expiry", with_sql("ohlc", body=f"SELECT 'date=' || strftime(m, '%Y-%m-%d') AS folder FROM (SELECT DISTINCT date_trunc('month', trade_date) AS m FROM ohlc) WHERE DATE '2002-01-01' - CAST(m AS DATE) <= 1000 UNION ALL SELECT 'date=undated'"))
def _(m):
    path, as_of = monthly_dataset(m), F.lit("2002-01-01").cast("date")
    files.drop_expired(m.spark, path, "date", as_of, 1000, dry_run=False)
    return files.partition_ages(m.spark, path, "date", as_of).select("folder")


@query("snk08_ttl", with_sql("ohlc", body=f"{CLOSE_SQL} WHERE trade_date >= DATE '2001-06-30' - INTERVAL 3 YEAR"))
def _(m):
    return lw.within_ttl(m.closes, "normalized_equity_ohlc", F.lit("2001-06-30").cast("date")).withColumn("close", r4("close"))


@query("snk09_dataset_manifest", with_sql("ohlc", body="SELECT 'bars' AS dataset, count(*) AS n_rows, 3 AS fields FROM ohlc"))
def _(m):
    path = fresh_path(m.spark, "bars")
    lw.write_dataset(m.closes, path, [])
    row = manifest.describe_dataset(m.spark, path, "bars")
    return row.select("dataset", "n_rows", F.json_array_length(F.get_json_object("schema_json", "$.fields")).alias("fields"))


@query("snk10_idempotent_write", with_sql("ohlc", body="SELECT 'written,skipped,written,skipped' AS outcomes, count(*) AS n_rows, 2 AS manifest_rows FROM ohlc"))
def _(m):
    """Write, repeat, damage the data, repeat: only the damage causes another write."""
    base = fresh_path(m.spark, "once")
    args = ("bars", "all-days", f"{base}/data", f"{base}/manifest")
    done = [manifest.write_once(bars(m), *args, "2024-01-01 00:00:00"), manifest.write_once(bars(m), *args, "2024-01-01 01:00:00")]
    bars(m).filter("symbol = 'S1'").write.mode("append").parquet(f"{base}/data")
    done += [manifest.write_once(bars(m), *args, "2024-01-01 02:00:00"), manifest.write_once(bars(m), *args, "2024-01-01 03:00:00")]
    marks = manifest.read_manifest(m.spark, f"{base}/manifest").agg(F.count("*")).scalar()
    stored = read_lake(m.spark, f"{base}/data").agg(F.count("*").alias("n_rows"))
    return stored.select(F.lit(",".join(done)).alias("outcomes"), "n_rows", marks.cast("int").alias("manifest_rows"))


SERVING_REQUIRED = ["TckrSymb", "TradDt", "ClsPric", "event_time"]


def serving_rows(m):
    rows = m.closes.select(
        "symbol", F.date_format("trade_date", "yyyy-MM-dd").alias("trade_date"), r4("close").alias("close"),
        F.unix_millis(F.col("trade_date").cast("timestamp")).alias("event_time"),
    )
    return lw.prepare_for_serving(rows, SERVING_REQUIRED, date_cols=("TradDt",), ms_cols=("event_time",))


@query("snk11_serving_load", with_sql("ohlc", body=f'SELECT symbol AS "TckrSymb", trade_date AS "TradDt", {sql4("close")} AS "ClsPric", CAST(trade_date AS TIMESTAMP) AS event_time FROM ohlc'))
def _(m):
    path = fresh_path(m.spark, "serving")
    lw.write_dataset(serving_rows(m), path, [], sort_by=("TckrSymb", "TradDt"))
    return read_lake(m.spark, path).withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


@query("snk12_load_sample", with_sql("ohlc", body=f'SELECT symbol AS "TckrSymb", trade_date AS "TradDt", {sql4("close")} AS "ClsPric" FROM ohlc ORDER BY symbol, trade_date LIMIT 5'))
def _(m):
    """The five first rows of a load, for a look at what arrived."""
    path = fresh_path(m.spark, "serving")
    lw.write_dataset(serving_rows(m), path, [])
    return lw.load_sample(read_lake(m.spark, path), ["TckrSymb", "TradDt"]).select("TckrSymb", "TradDt", "ClsPric")


@query("snk12_verify_load", with_sql("ohlc", body="SELECT count(*) AS actual, count(*) AS expected, true AS complete FROM ohlc"))
def _(m):
    path = fresh_path(m.spark, "serving")
    lw.write_dataset(serving_rows(m), path, [])
    return lw.verify_load(read_lake(m.spark, path), m.trades.select("symbol", "trade_date").distinct())


@query("snk13_replace_day", with_sql("ohlc", body="SELECT trade_date, count(*) AS n, CAST(sum(volume) AS BIGINT) AS volume FROM ohlc GROUP BY 1"))
def _(m):
    """Loading the first quarter of every year again leaves each day once."""
    path = fresh_path(m.spark, "replaced")
    rows = m.ohlc.select("symbol", "volume", "trade_date", F.trunc("trade_date", "MM").alias("month"))
    for part in (rows, rows.filter("month(trade_date) <= 3")):
        lw.write_dataset(part, path, ["month"])
    return read_lake(m.spark, path).groupBy("trade_date").agg(F.count("*").alias("n"), F.sum("volume").alias("volume"))


@query("snk14_csv_write", "SELECT count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS keys FROM customer")
def _(m):
    path = fresh_path(m.spark, "customers")
    customer = m.table("customer")
    lw.write_csv(customer, path)
    back = m.spark.read.schema(customer.schema).option("header", True).csv(path)
    return back.agg(F.count("*").alias("n"), F.sum("c_custkey").alias("keys"))


@query(
    "snk15_quarantine_and_audit",
    with_sql("dirty", body=f"""SELECT (SELECT count(DISTINCT event_id) FROM ({rule_sql(QUARANTINE_RULES)})) AS quarantined, count(*) AS audited_total, (SELECT count(DISTINCT event_id) FROM ({rule_sql(QUARANTINE_RULES)})) AS audited_failed FROM dirty"""),
)
def _(m):
    """A run that fails is stopped and tried again: one audit row, one copy of each quarantined row."""
    base = fresh_path(m.spark, "checked")
    rows = m.with_stored_bars().dirty  # three jobs read them
    checks = rules.checks_for(rows, SETTINGS, QUARANTINE_RULES)
    args = (rows, f"{base}/data", [], checks, "normalized_equity_ohlc", f"{base}/quarantine", f"{base}/audit", STAMP)
    with contextlib.suppress(lw.ValidationFailed):
        lw.write_checked(*args, fail=True, run_id="day-1")
    lw.write_checked(*args, run_id="day-1")
    book = runs.ledger(m.spark, lw.ledger_path(f"{base}/audit"))
    bad = runs.visible(read_lake(m.spark, f"{base}/quarantine"), book).agg(F.count("*")).scalar()
    audit = runs.visible(m.spark.read.json(f"{base}/audit"), book)
    return audit.select(bad.alias("quarantined"), F.col("total_rows").alias("audited_total"), F.col("failed_rows").alias("audited_failed"))


@query("snk16_feature_export", with_sql("ohlc", body="SELECT v AS feature_version, count(*) AS n, count(CASE WHEN v = 'v1' THEN 1 END) AS first_version FROM ohlc, (VALUES ('v1'), ('v2')) t(v) GROUP BY 1"))
def _(m):
    """A second version is stored beside the first."""
    path = fresh_path(m.spark, "features")
    for version in ("v1", "v2", "v2"):
        lw.write_features(features(m.closes, version, STAMP_MS), path)
    stored = read_lake(m.spark, path)
    return stored.groupBy("feature_version").agg(F.count("*").alias("n"), F.count_if(F.col("feature_version") == "v1").alias("first_version"))


@query(
    "snk17_backfill_outcomes",
    with_sql("calendar", "deals", body="""SELECT c.trade_date, coalesce(n, 0) AS loaded, CASE WHEN n IS NOT NULL THEN 'loaded' WHEN is_trading_day THEN 'no data' ELSE 'closed' END AS outcome FROM calendar c LEFT JOIN
 (SELECT deal_date, count(*) AS n FROM deals GROUP BY 1) d ON d.deal_date = c.trade_date"""),
)
def _(m):
    """One job loads the whole range; the outcome of each day is read off the stored data."""
    from ticklake.plans.joins import calendar_of

    path = fresh_path(m.spark, "backfill")
    lw.write_dataset(m.deals.withColumn("year", F.year("deal_date")), path, ["year"], sort_by=("deal_date", "symbol"))
    per_day = read_lake(m.spark, path).groupBy(F.col("deal_date").alias("trade_date")).agg(F.count("*").alias("loaded"))
    days = calendar_of(m).select("trade_date", "is_trading_day")
    outcome = F.when(F.col("loaded").isNotNull(), "loaded").when(F.col("is_trading_day"), "no data").otherwise("closed")
    return days.join(per_day, "trade_date", "left").select("trade_date", F.coalesce("loaded", F.lit(0)).alias("loaded"), outcome.alias("outcome"))
