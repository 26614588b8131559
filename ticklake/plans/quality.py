"""DQ and RPT: data-quality rules over bars with planted defects, quarantine, audit, reports."""

from pyspark.sql import functions as F

from ticklake import schemas
from ticklake.bridge import with_sql
from ticklake.functions.rounding import r4, sql4
from ticklake.lake import runs
from ticklake.lake import write as lw
from ticklake.operators.dedupe import duplicate_keys
from ticklake.operators.versions import scd2_build
from ticklake.plans.joins import calendar_of
from ticklake.plans.registry import query
from ticklake.quality import outcome, reports, rules, shape
from ticklake.session import fresh_path

AS_OF = "2030-01-01 00:00:00"
SETTINGS = rules.Settings(as_of=AS_OF)
STAMP = "2030-01-01 00:00:00"

MS = "epoch_ms"
LIMIT = f"({MS}(TIMESTAMP '{AS_OF}') + 3600000)"
PRICE_FIELDS = ("prev_close", "open", "high", "low", "close")

#: rule -> (severity, {field: SQL predicate of a bad row})
RULE_SQL = {
    "high_below_low": ("critical", {"high,low": "high < low"}),
    "close_outside_range": ("critical", {"close": "close < low OR close > high"}),
    "open_outside_range": ("critical", {"open": "open < low OR open > high"}),
    "trades_without_volume": ("critical", {"volume,trades": "volume = 0 AND trades > 0"}),
    "turnover_deviates": ("warning", {"turnover,volume": "volume > 0 AND turnover > 0 AND abs(turnover - volume * close) / (volume * close) * 100 > 10"}),
    "price_jump": ("warning", {"close": "prev_close > 0 AND abs(close - prev_close) / prev_close * 100 > 20"}),
    "bad_adjustment_factor": ("critical", {"adjustment_factor": "adjustment_date IS NOT NULL AND adjustment_factor <= 0"}),
    "stale": ("warning", {"ingest_time,event_time": f"({MS}(ingest_time) - {MS}(event_time)) / 3600000.0 > 48"}),
    "impossible_time": ("critical", {c: f"{MS}({c}) < 0 OR {MS}({c}) > {LIMIT}" for c in ("event_time", "ingest_time")}),
    "negative_price": ("critical", {c: f"{c} < 0" for c in PRICE_FIELDS}),
    "negative_volume": ("critical", {"volume": "volume < 0"}),
    "date_out_of_range": ("critical", {"trade_date": f"trade_date < DATE '1990-01-01' OR trade_date > CAST(TIMESTAMP '{AS_OF}' AS DATE) + 1"}),
    "trading_day_without_volume": ("warning", {"is_trading_day,volume": "is_trading_day AND volume = 0"}),
}
DQ_IDS = {
    "high_below_low": "dq02", "close_outside_range": "dq03", "open_outside_range": "dq04", "trades_without_volume": "dq05", "turnover_deviates": "dq06",
    "price_jump": "dq07", "bad_adjustment_factor": "dq08", "stale": "dq10", "impossible_time": "dq11", "negative_price": "dq13", "negative_volume": "dq14",
    "date_out_of_range": "dq15", "trading_day_without_volume": "dq16",
}


def rule_sql(names) -> str:
    return " UNION ALL ".join(
        f"SELECT event_id, '{n}' AS rule, '{RULE_SQL[n][0]}' AS severity, '{f}' AS field FROM dirty WHERE {p}" for n in names for f, p in RULE_SQL[n][1].items()
    )


for _rule, _id in DQ_IDS.items():

    def _run(m, rule=_rule):
        found = rules.violations(m.dirty, rules.checks_for(m.dirty, SETTINGS, [rule]))
        return found.drop("message")

    query(f"{_id}_{_rule}", with_sql("dirty", body=rule_sql([_rule])))(_run)

CONTRACT_SQL = {
    "schema_version": "NOT regexp_matches(schema_version, '^v[0-9]+$')", "symbol": "length(symbol) < 1", "exchange": "exchange NOT IN ('NSE', 'BSE')",
    "isin": "NOT regexp_matches(isin, '^([A-Z]{2}[A-Z0-9]{9}[0-9])?$')", "close": "close IS NULL", "open": "open < 0", "high": "high < 0", "low": "low < 0",
    "volume": "volume < 0", "adjustment_factor": "adjustment_factor <= 0",
}


@query("dq01_contract", with_sql("dirty", body=" UNION ALL ".join(f"SELECT event_id, 'contract' AS rule, '{f}' AS field FROM dirty WHERE {p}" for f, p in CONTRACT_SQL.items())))
def _(m):
    return rules.violations(m.dirty, rules.contract_checks(schemas.NORMALIZED_CONTRACT, m.dirty.columns)).drop("message", "severity")


@query(
    "dq01_contract_types",
    with_sql("dirty", body="""SELECT 'trades' AS field, 'bigint' AS agreed, 'string' AS actual, CAST(count_if(trades = 2) AS BIGINT) AS n FROM dirty
 UNION ALL SELECT 'extra_column', 'absent', 'double', count(close) FROM dirty"""),
)
def _(m):
    shown = F.when(F.col("trades") == 2, "two").otherwise(F.col("trades").cast("string"))
    odd = m.dirty.withColumns({"trades": shown, "extra_column": F.col("close")})
    return shape.type_report(odd, rules.contract_type_errors(schemas.NORMALIZED_CONTRACT, odd.schema))


DUP_SQL = "SELECT min(event_id) AS event_id, 'duplicate_key' AS rule, 'critical' AS severity, 'entity_id,trade_date' AS field FROM dirty GROUP BY entity_id, trade_date HAVING count(*) > 1"


@query("dq09_duplicate_key", with_sql("dirty", body=DUP_SQL))
def _(m):
    return rules.duplicate_violations(m.dirty, ["entity_id", "trade_date"]).drop("message")


@query("dq12_null_critical_field", with_sql("dirty", body="SELECT field, n || ' nulls' AS message FROM (SELECT 'close' AS field, count(*) AS n FROM dirty WHERE close IS NULL) WHERE n > 0"))
def _(m):
    return rules.null_violations(m.dirty, rules.critical_fields("normalized_equity_ohlc")).select("field", "message")


ALL_SQL = rule_sql(rules.ROW_RULES)


def flagged(m, names=rules.ROW_RULES):
    return rules.flag(m.dirty, rules.checks_for(m.dirty, SETTINGS, names))


@query("dq17_all_rules", with_sql("dirty", body=f"SELECT rule, field, count(*) AS n FROM ({ALL_SQL}) GROUP BY 1, 2"))
def _(m):
    """Every rule in one pass over the rows."""
    names = rules.rules_for_table("normalized_equity_ohlc")
    found = flagged(m, names).select(F.inline(rules.FLAGS))
    return found.groupBy("rule", "field").agg(F.count("*").alias("n"))


@query("dq17_general_rules_only", with_sql("dirty", body="SELECT rule, count(*) AS n FROM (" + rule_sql(r for r in rules.ROW_RULES if r not in rules.PRICE_TABLE_RULES) + ") GROUP BY 1"))
def _(m):
    found = flagged(m, rules.rules_for_table("symbol_master")).select(F.inline(rules.FLAGS))
    return found.groupBy("rule").agg(F.count("*").alias("n"))


@query(
    "dq18_custom_rules",
    with_sql("dirty", body="""SELECT rule, count(*) AS n FROM (SELECT 'penny' AS rule FROM dirty WHERE close < 100 UNION ALL SELECT 'thin_symbol' FROM dirty GROUP BY entity_id HAVING sum(volume) < 14000) GROUP BY 1"""),
)
def _(m):
    registry = rules.Registry()
    registry.predicates["penny"] = lambda df: rules.Check("penny", "warning", "close", F.col("close") < 100, F.lit("cheap"))
    registry.predicates["broken"] = lambda df: rules.Check("broken", "warning", "nope", F.col("no_such_column") > 1, F.lit("never"))
    registry.tables["thin_symbol"] = lambda df: (
        df.groupBy("entity_id").agg(F.sum("volume").alias("v")).filter("v < 14000").select(F.lit("thin_symbol").alias("rule"))
    )
    found = rules.violations(m.dirty, registry.checks(m.dirty)).select("rule")
    for extra in registry.table_violations(m.dirty):
        found = found.unionByName(extra)
    return found.groupBy("rule").agg(F.count("*").alias("n"))


SUMMARY_SQL = f""", v AS ({ALL_SQL}), n AS (SELECT count(*) AS total_rows FROM dirty)
 SELECT total_rows, total_rows - count(DISTINCT event_id) AS valid_rows, count(DISTINCT event_id) AS failed_rows, count(*) AS critical_failures, CAST(count_if(severity = 'warning') AS BIGINT) AS warnings FROM v, n GROUP BY total_rows"""


@query("dq19_summary", with_sql("dirty", body=SUMMARY_SQL))
def _(m):
    return outcome.summary(flagged(m))


QUARANTINE_RULES = ("high_below_low", "negative_price", "negative_volume", "date_out_of_range")


@query(
    "dq20_quarantine",
    with_sql("dirty", body=f"""SELECT event_id, string_agg(DISTINCT rule, ',' ORDER BY rule) AS rules, 'critical' AS error_types, 'normalized_equity_ohlc' AS schema_name, CAST(0 AS INTEGER) AS retry_count
 FROM ({rule_sql(QUARANTINE_RULES)}) GROUP BY 1"""),
)
def _(m):
    q = outcome.quarantine_rows(flagged(m, QUARANTINE_RULES), "normalized_equity_ohlc", STAMP)
    ordered = F.array_join(F.array_sort(F.split("rules", ",")), ",")
    return q.select("event_id", ordered.alias("rules"), "error_types", "schema_name", "retry_count")


@query("dq21_audit_row", with_sql("dirty", body=f"SELECT 'normalized_equity_ohlc' AS schema_name, failed_rows, total_rows, {sql4('failed_rows / total_rows')} AS failure_rate FROM (WITH s AS (SELECT 1) SELECT * FROM (SELECT count(DISTINCT event_id) AS failed_rows FROM ({rule_sql(QUARANTINE_RULES)})), (SELECT count(*) AS total_rows FROM dirty))"))
def _(m):
    row = outcome.audit_row(outcome.summary(flagged(m, QUARANTINE_RULES)), "normalized_equity_ohlc", QUARANTINE_RULES, "quarantine", STAMP)
    return row.select("schema_name", "failed_rows", "total_rows", r4("failure_rate").alias("failure_rate"))


@query("dq22_gate", with_sql("dirty", body=f"SELECT failed_rows, {sql4('failed_rows / total_rows')} AS failure_rate, failed_rows / total_rows <= 0.05 AS passed FROM (SELECT count(DISTINCT event_id) AS failed_rows FROM ({rule_sql(QUARANTINE_RULES)})), (SELECT count(*) AS total_rows FROM dirty)"))
def _(m):
    return outcome.gate(outcome.summary(flagged(m, QUARANTINE_RULES))).select("failed_rows", r4("failure_rate").alias("failure_rate"), "passed")


@query(
    "dq23_batch_validation",
    with_sql("dirty", body=f"""SELECT CAST(d.y AS INTEGER) AS y, total, coalesce(failed, 0) AS failed FROM (SELECT year(trade_date) AS y, count(*) AS total FROM dirty GROUP BY 1) d LEFT JOIN
 (SELECT year(trade_date) AS y, count(DISTINCT event_id) AS failed FROM dirty WHERE event_id IN (SELECT event_id FROM ({rule_sql(QUARANTINE_RULES)})) GROUP BY 1) f ON d.y = f.y"""),
)
def _(m):
    """Files of a dataset validated in one job and summed per file group."""
    path = fresh_path(m.spark, "batch-validation")
    # a year is as large as the data makes it: the hint splits one that is too large for a task into several files
    m.dirty.withColumn("y", F.year("trade_date")).hint("rebalance", "y").write.partitionBy("y").parquet(path)
    files = m.spark.read.option("recursiveFileLookup", True).parquet(path).withColumn("file", F.col("_metadata.file_path"))
    out = rules.flag(files, rules.checks_for(files, SETTINGS, QUARANTINE_RULES))
    per_file = out.groupBy("file").agg(F.count("*").alias("total"), F.count_if(F.size(rules.FLAGS) > 0).alias("failed"))
    year = F.regexp_extract("file", r"/y=(\d+)/", 1).cast("int")
    return per_file.groupBy(year.alias("y")).agg(F.sum("total").alias("total"), F.sum("failed").alias("failed"))


@query("dq24_macro_completeness", with_sql("macro", body=f"SELECT count(*) AS n, CAST(count_if(v IS NULL) AS BIGINT) AS null_values, {sql4('avg(v)')} AS mean, {sql4('stddev(v)')} AS std, min(v) AS lowest, max(v) AS highest FROM (SELECT CASE WHEN month(indicator_date) = 3 THEN NULL ELSE value END AS v FROM macro)"))
def _(m):
    v = F.when(F.month("indicator_date") != 3, F.col("value"))
    return m.macro.select(v.alias("v")).agg(
        F.count("*").alias("n"), F.count_if(F.col("v").isNull()).alias("null_values"), r4(F.avg("v")).alias("mean"), r4(F.stddev("v")).alias("std"),
        F.min("v").alias("lowest"), F.max("v").alias("highest"),
    )


@query("dq25_macro_duplicates", "SELECT o_orderpriority AS indicator_code, CAST(o_orderdate AS DATE) AS indicator_date, count(*) AS copies FROM orders GROUP BY 1, 2 HAVING copies > 1")
def _(m):
    rows = m.table("orders").select(F.col("o_orderpriority").alias("indicator_code"), F.to_date("o_orderdate").alias("indicator_date"))
    return duplicate_keys(rows, ["indicator_code", "indicator_date"])


@query(
    "dq26_reference_rules",
    with_sql("master_changes", "ca", "calendar", body=""", v AS (SELECT symbol, status, as_of AS valid_from, lead(as_of) OVER (PARTITION BY symbol ORDER BY as_of) AS valid_to FROM
   (SELECT *, lag(status) OVER (PARTITION BY symbol ORDER BY as_of) AS p FROM master_changes) WHERE p IS NULL OR p <> status),
 c AS (SELECT *, CASE WHEN day(ex_date) % 5 = 0 THEN ex_date - 1 ELSE ex_date + 1 END AS record_date, day(ex_date) AS d FROM ca)
 SELECT rule, count(*) AS n FROM (
  SELECT 'status_unknown' AS rule FROM v WHERE status NOT IN ('F', 'O') UNION ALL
  SELECT 'valid_range' FROM v WHERE valid_from > CASE WHEN length(symbol) = 2 THEN valid_from - 1 ELSE valid_to END UNION ALL
  SELECT 'isin_format' FROM v WHERE length(symbol) = 3 UNION ALL
  SELECT 'lot_not_positive' FROM v WHERE length(symbol) = 4 UNION ALL
  SELECT 'record_before_ex' FROM c WHERE record_date < ex_date UNION ALL
  SELECT 'ex_before_announcement' FROM c WHERE d % 7 = 0 UNION ALL
  SELECT 'closure_order' FROM c WHERE d % 6 = 0 UNION ALL
  SELECT 'factor_not_positive' FROM c WHERE action_type = 'SPLIT' OR (d % 3 = 0 AND action_type <> 'DIVIDEND') UNION ALL
  SELECT 'purpose_empty' FROM c WHERE d % 4 = 0 UNION ALL
  SELECT 'ca_id_not_unique' FROM c WHERE d % 11 = 0 UNION ALL
  SELECT 'clearing_before_trade' FROM calendar WHERE weekday = 1 UNION ALL
  SELECT 'settlement_before_clearing' FROM calendar WHERE weekday = 2 UNION ALL
  SELECT 'session_order' FROM calendar WHERE weekday = 3 UNION ALL
  SELECT 'open_day_without_segment' FROM calendar WHERE is_trading_day AND weekday = 5) GROUP BY 1"""),
)
def _(m):
    """Every rule of the reference tables, each over rows with a planted defect."""

    def broken(df, checks, key):
        return rules.violations(df, checks(df.columns), key).select("rule")

    v = scd2_build(m.master_changes, "symbol", "as_of", ["status"])
    length = F.length("symbol")
    v = v.withColumns(
        {
            "valid_to": F.when(length == 2, F.date_sub("valid_from", 1)).otherwise(F.col("valid_to")),
            "isin": F.when(length == 3, "INE-1").otherwise(F.concat(F.lit("INE"), F.lpad(F.substring("symbol", 2, 9), 9, "0"))),
            "lot_size": F.when(length == 4, 0).otherwise(25),
        }
    )
    d = F.day("ex_date")
    c = m.ca.withColumns(
        {
            "record_date": F.when(d % 5 == 0, F.date_sub("ex_date", 1)).otherwise(F.date_add("ex_date", 1)),
            "announcement_date": F.when(d % 7 == 0, F.date_add("ex_date", 1)),
            "book_closure_start_date": F.col("ex_date"),
            "book_closure_end_date": F.when(d % 6 == 0, F.date_sub("ex_date", 1)).otherwise(F.date_add("ex_date", 3)),
            "adjustment_factor": F.when(F.col("action_type") == "SPLIT", -F.col("adjustment_factor")).when(d % 3 == 0, 0.0).otherwise(F.col("adjustment_factor")),
            "purpose": F.when(d % 4 == 0, " ").otherwise(F.col("action_type")),
        }
    )
    closed_friday = F.transform("segments", lambda s: F.struct(s["segment"].alias("segment"), (s["is_open"] & (F.col("weekday") != 5)).alias("is_open")))
    weekday = F.col("weekday")
    day = calendar_of(m).withColumns(
        {
            "segments": closed_friday,
            "clearing_date": F.when(weekday == 1, F.date_sub("trade_date", 1)).otherwise(F.date_add("trade_date", 1)),
            "settlement_date": F.when(weekday == 2, F.col("trade_date")).otherwise(F.date_add("trade_date", 2)),
            "pre_open_start": F.lit(540), "pre_open_end": F.when(weekday == 3, 540).otherwise(548), "normal_open": F.lit(555), "normal_close": F.lit(930),
        }
    )
    named = c.withColumn("ca_id", F.concat_ws(":", "symbol", "ex_date"))
    twice = duplicate_keys(named.unionByName(named.filter(d % 11 == 0)).select("ca_id"), ["ca_id"]).select(F.lit("ca_id_not_unique").alias("rule"))
    found = broken(v, lambda cols: rules.master_checks(cols, ("F", "O")), "symbol")
    found = found.unionByName(broken(c, rules.action_checks, "symbol")).unionByName(broken(day, rules.calendar_checks, "trade_date"))
    return found.unionByName(twice).groupBy("rule").agg(F.count("*").alias("n"))


@query(
    "dq27_daily_quality",
    with_sql("dirty", body=f"""SELECT trade_date, count(*) AS "rows", {sql4("(1 - sum(CASE WHEN close IS NULL THEN 1 ELSE 0 END) / (count(*) * 4)) * 100")} AS completeness_pct,
 count(*) FILTER (WHERE close <= 0 OR close > 1000000) AS invalid_prices, {sql4("(1 - count(*) FILTER (WHERE close <= 0 OR close > 1000000) / count(*)) * 100")} AS validity_pct,
 count(*) FILTER (WHERE turnover = 0 AND volume > 0) AS inconsistent, {sql4("(epoch(TIMESTAMP '2030-01-01 00:00:00') - epoch(CAST(trade_date AS TIMESTAMP))) / 3600")} AS freshness_hours FROM dirty GROUP BY 1"""),
)
def _(m):
    out = outcome.daily_quality(m.dirty.select("trade_date", "close", "volume", "turnover"), "trade_date", AS_OF)
    return out.withColumns({c: r4(c) for c in ("completeness_pct", "validity_pct", "freshness_hours")})


@query("dq28_event_time_skew", with_sql("dirty", body="SELECT event_id, epoch_ms(event_time) - epoch_ms(ingest_time) > 300000 AS skewed FROM dirty WHERE epoch_ms(event_time) - epoch_ms(ingest_time) > 300000"))
def _(m):
    late = F.unix_millis("event_time") - F.unix_millis("ingest_time") > 5 * 60_000
    return m.dirty.filter(late).select("event_id", F.lit(True).alias("skewed"))


@query("dq28_event_id_unique", "SELECT l_orderkey || ':' || l_linenumber AS event_id, count(*) AS copies FROM lineitem GROUP BY 1 HAVING copies > 1")
def _(m):
    ids = m.table("lineitem").select(F.concat_ws(":", "l_orderkey", "l_linenumber").alias("event_id"))
    return duplicate_keys(ids, ["event_id"])


@query(
    "dq29_column_diff",
    with_sql("ohlc", body="SELECT 'missing' AS problem, 'TtlTrfVal' AS column_name, CAST(0 AS BIGINT) AS n UNION ALL SELECT 'unexpected', 'Surprise', CAST(count_if(suppkey % 2 = 0) AS BIGINT) FROM ohlc"),
)
def _(m):
    from ticklake.plans.rendering import price_cells

    surprise = F.when(F.col("FinInstrmId").cast("int") % 2 == 0, 1)
    return shape.column_report(price_cells(m).drop("TtlTrfVal").withColumn("Surprise", surprise), list(schemas.PRICE_FEED))


@query(
    "dq30_schema_evolution",
    with_sql("ohlc", body="""SELECT 'trades' AS field, 'int -> bigint' AS change, true AS allowed, count(*) AS n FROM ohlc UNION ALL SELECT 'turnover', 'removed', false, 0
 UNION ALL SELECT 'note', 'added', true, CAST(count_if(trades > 1) AS BIGINT) FROM ohlc UNION ALL SELECT 'close', 'double -> string', false, count(*) FROM ohlc"""),
)
def _(m):
    old = m.ohlc.withColumn("trades", F.col("trades").cast("int"))
    note = F.when(F.col("trades") > 1, F.lit("several trades"))
    new = m.ohlc.drop("turnover").withColumns({"note": note, "close": F.col("close").cast("string")})
    return shape.evolution_report(old, new)


@query(
    "dq31_quarantine_replay",
    with_sql("dirty", body="""SELECT CASE WHEN fine THEN 'accepted' ELSE 'quarantined' END AS state, CASE WHEN fine THEN 0 ELSE 1 END AS retry_count, count(*) AS n,
 CAST(sum(CASE WHEN volume < 0 AND fine THEN 5 ELSE volume END) AS BIGINT) AS volume
 FROM (SELECT volume, volume IS NULL OR volume >= 0 OR coalesce(TRY_CAST(substr(symbol, 2) AS BIGINT) % 2 = 0, false) AS fine FROM dirty) GROUP BY fine"""),
)
def _(m):
    """Negative volumes are quarantined, half of them corrected, and all of them validated again; run and replay are
    both repeated, which changes nothing."""
    base = fresh_path(m.spark, "replayed")
    rows = m.dirty.withColumn("year", F.year("trade_date"))
    checks = rules.checks_for(m.dirty, SETTINGS, ("negative_volume",))
    table, places = "normalized_equity_ohlc", (f"{base}/quarantine", f"{base}/audit")
    for _ in range(2):
        lw.write_checked(rows, f"{base}/data", ["year"], checks, table, *places, STAMP, run_id="day-1")
    bad = m.spark.read.parquet(f"{places[0]}/run=day-1")
    fixes = bad.filter(F.substring("entity_id", 2, 20).rlike("^[0-9]*[02468]:")).select("event_id", F.lit(5).cast("bigint").alias("volume"))
    for _ in range(2):
        lw.replay_run(m.spark, "day-1", "fix-1", fixes, "event_id", f"{base}/data", ["year"], checks, table, *places, STAMP)
    stored = m.spark.read.parquet(f"{base}/data").select(F.lit("accepted").alias("state"), F.lit(0).alias("retry_count"), "volume")
    left = runs.still_open(m.spark.read.parquet(places[0]), runs.ledger(m.spark, lw.ledger_path(places[1])))
    both = stored.unionByName(left.select(F.lit("quarantined").alias("state"), "retry_count", "volume"))
    return both.groupBy("state", "retry_count").agg(F.count("*").alias("n"), F.sum("volume").alias("volume"))


# --- reports over an audit log with one entry per day and deal type, some lines malformed

AUDIT_SQL = """, audit AS (SELECT deal_date, deal_type, CAST(count_if(quantity > CASE WHEN day(deal_date) % 7 = 0 THEN 30 ELSE 48 END) AS BIGINT) AS failed_rows, count(*) AS total_rows FROM deals GROUP BY 1, 2),
 log AS (SELECT * FROM audit WHERE NOT (deal_type = 'BULK' AND day(deal_date) = 13) AND deal_date >= DATE '2000-01-01' - 365),
 rep AS (SELECT deal_date AS report_date, count(*) AS validations, CAST(sum(total_rows) AS BIGINT) AS rows_validated, CAST(sum(failed_rows) AS BIGINT) AS failures, sum(failed_rows) / sum(total_rows) AS failure_rate,
   string_agg(DISTINCT deal_type, ',' ORDER BY deal_type) AS schemas FROM log GROUP BY 1)"""
AUDIT_AS_OF = "2000-01-01 00:00:00"


def audit_log(m):
    limit = F.when(F.day("deal_date") % 7 == 0, 30).otherwise(48)
    per = m.deals.groupBy("deal_date", "deal_type").agg(F.count_if(F.col("quantity") > limit).alias("failed_rows"), F.count("*").alias("total_rows"))
    line = F.to_json(
        F.struct(
            F.date_format("deal_date", "yyyy-MM-dd'T'10:00:00").alias("timestamp"), F.col("deal_type").alias("schema_name"), F.lit("q").alias("quarantine_file"),
            "failed_rows", "total_rows", F.array(F.lit("b"), F.concat(F.lit("a_"), "deal_type")).alias("rules_applied"),
        )
    )
    broken = (F.col("deal_type") == "BULK") & (F.day("deal_date") == 13)
    path = fresh_path(m.spark, "audit")
    per.select(F.when(broken, F.concat(F.lit("{"), line)).otherwise(line).alias("value")).write.text(path)
    return reports.load_audit(m.spark, path, F.lit(AUDIT_AS_OF).cast("timestamp"), 365)


@query("rpt01_audit_window", with_sql("deals", body=f"{AUDIT_SQL} SELECT deal_type AS schema_name, count(*) AS entries, CAST(sum(failed_rows) AS BIGINT) AS failed_rows FROM log GROUP BY 1"))
def _(m):
    return audit_log(m).groupBy("schema_name").agg(F.count("*").alias("entries"), F.sum("failed_rows").alias("failed_rows"))


@query("rpt02_daily_report", with_sql("deals", body=f"{AUDIT_SQL} SELECT * REPLACE ({sql4('failure_rate')} AS failure_rate), 'a_' || replace(schemas, ',', ',a_') || ',b' AS rules FROM rep"))
def _(m):
    return reports.daily_report(audit_log(m)).withColumn("failure_rate", r4("failure_rate"))


def trend_sql(now, before, limit):
    change = f"CASE WHEN {before} > 0 THEN ({now} - {before}) / {before} * 100 ELSE 0 END"
    return f"{sql4(change)} AS change_pct, CASE WHEN {change} > {limit} THEN 'increasing' WHEN {change} < -{limit} THEN 'decreasing' ELSE 'stable' END AS trend"


@query(
    "rpt03_trends",
    with_sql("deals", body=f"""{AUDIT_SQL}, b AS (SELECT r.report_date, r.failure_rate, r.rows_validated, p.failure_rate AS pr, p.rows_validated AS pv FROM rep r JOIN rep p ON r.report_date = p.report_date + 1)
 SELECT report_date, 'failure_rate' AS metric, {trend_sql("failure_rate", "pr", 10)} FROM b UNION ALL SELECT report_date, 'validation_volume', {trend_sql("rows_validated", "pv", 20)} FROM b"""),
)
def _(m):
    out = reports.trends(reports.daily_report(audit_log(m)))
    return out.select("report_date", "metric", r4("change_pct").alias("change_pct"), "trend")


@query(
    "rpt04_anomalies",
    with_sql("deals", body=f"""{AUDIT_SQL} SELECT report_date, 'high_rate' AS kind, '' AS schema_name, {sql4("failure_rate")} AS value FROM rep WHERE failure_rate > 0.05
 UNION ALL SELECT deal_date, 'schema_rate', deal_type, {sql4("failed_rows / total_rows")} FROM log WHERE failed_rows / total_rows > 0.1
 UNION ALL SELECT report_date, 'volume_spike', '', validations FROM (SELECT r.report_date, r.validations, (SELECT sum(p.validations) FROM rep p WHERE p.report_date BETWEEN r.report_date - 6 AND r.report_date) AS w FROM rep r) WHERE w > validations AND validations > w / 7 * 2"""),
)
def _(m):
    return reports.anomalies(audit_log(m)).withColumn("value", r4("value"))


@query("rpt05_daily_series", with_sql("deals", body=f"{AUDIT_SQL} SELECT report_date, rows_validated AS volume, failures, {sql4('failure_rate')} AS failure_rate FROM rep"))
def _(m):
    return reports.daily_series(audit_log(m)).withColumn("failure_rate", r4("failure_rate"))
