import datetime as dt

import pytest
from pyspark.sql import functions as F

from ticklake import schemas
from ticklake.quality import outcome, reports, rules, shape

AS_OF = "2024-02-01 00:00:00"
SETTINGS = rules.Settings(as_of=AS_OF)
GOOD = {
    "event_id": "e1", "event_time": dt.datetime(2024, 1, 15), "ingest_time": dt.datetime(2024, 1, 15, 18), "source": "feed", "schema_version": "v1",
    "entity_id": "A:NSE", "instrument_id": "A:NSE", "symbol": "A", "exchange": "NSE", "isin": "INE002A01018", "instrument_type": "STK", "series": "EQ",
    "trade_date": dt.date(2024, 1, 15), "prev_close": 100.0, "open": 100.0, "high": 110.0, "low": 95.0, "close": 105.0, "last_price": 105.0,
    "settlement_price": None, "volume": 1000, "turnover": 105000.0, "trades": 10, "adjustment_factor": 1.0, "adjustment_date": None, "is_trading_day": True,
}
SCHEMA = ", ".join(f"{n} {w['type']}" for n, w in schemas.NORMALIZED_CONTRACT.items())


def rows(spark, *changes):
    made = [{**GOOD, "event_id": f"e{i}", "entity_id": f"A{i}:NSE", **c} for i, c in enumerate(changes)]
    return spark.createDataFrame([tuple(r[n] for n in schemas.NORMALIZED_CONTRACT) for r in made], SCHEMA)


def broken(df, checks):
    return sorted((r["event_id"], r["rule"], r["field"]) for r in rules.violations(df, checks).collect())


def test_good_row_passes_everything(spark):
    df = rows(spark, {})
    assert broken(df, rules.checks_for(df, SETTINGS)) == []
    assert broken(df, rules.contract_checks(schemas.NORMALIZED_CONTRACT, df.columns)) == []


@pytest.mark.parametrize(
    "change,expected",
    [
        ({"high": 80.0, "low": 100.0, "open": 90.0, "close": 90.0, "turnover": 90000.0}, {"high_below_low", "close_outside_range", "open_outside_range"}),
        ({"close": 120.0, "turnover": 120000.0}, {"close_outside_range"}),
        ({"open": 90.0}, {"open_outside_range"}),
        ({"volume": 0}, {"trades_without_volume", "trading_day_without_volume"}),
        ({"turnover": 120000.0}, {"turnover_deviates"}),
        ({"turnover": 110000.0}, set()),
        ({"prev_close": 80.0}, {"price_jump"}),
        ({"adjustment_factor": 0.0, "adjustment_date": dt.date(2024, 1, 1)}, {"bad_adjustment_factor"}),
        ({"adjustment_factor": 0.0}, set()),
        ({"ingest_time": dt.datetime(2024, 1, 18)}, {"stale"}),
        ({"event_time": dt.datetime(2024, 2, 1, 2), "ingest_time": dt.datetime(2024, 2, 1)}, {"impossible_time"}),
        ({"event_time": dt.datetime(1969, 12, 31), "ingest_time": dt.datetime(1969, 12, 31)}, {"impossible_time"}),
        ({"last_price": -1.0}, {"negative_price"}),
        ({"volume": -5}, {"negative_volume"}),
        ({"trade_date": dt.date(1985, 1, 1)}, {"date_out_of_range"}),
        ({"trade_date": dt.date(2024, 2, 3)}, {"date_out_of_range"}),
        ({"close": None, "high": None, "prev_close": None}, set()),
    ],
)
def test_one_defect_at_a_time(spark, change, expected):
    df = rows(spark, change)
    found = {r for _, r, _ in broken(df, rules.checks_for(df, SETTINGS))}
    assert found == expected


def test_rules_know_the_feed_names(spark):
    df = spark.createDataFrame([("e", 5, 0, 10.0, 100.0)], "event_id string, TtlNbOfTxsExctd bigint, TtlTradgVol bigint, ClsPric double, PrvsClsgPric double")
    assert {r for _, r, _ in broken(df, rules.checks_for(df, SETTINGS))} == {"trades_without_volume", "price_jump"}


def test_contract_findings(spark):
    df = rows(spark, {"exchange": "XXX", "isin": "bad", "symbol": "", "schema_version": "1", "close": None, "adjustment_factor": 0.0, "instrument_type": None})
    fields = {f for _, _, f in broken(df, rules.contract_checks(schemas.NORMALIZED_CONTRACT, df.columns))}
    assert fields == {"exchange", "isin", "symbol", "schema_version", "close", "adjustment_factor"}
    missing = rules.contract_checks(schemas.NORMALIZED_CONTRACT, df.drop("volume").columns)
    assert "volume" in {f for _, _, f in broken(df.drop("volume"), missing)}


def test_duplicates_report_one_row_per_key(spark):
    df = rows(spark, {"entity_id": "X"}, {"entity_id": "X"}, {"entity_id": "X"}, {"entity_id": "Y"})
    got = rules.duplicate_violations(df, ["entity_id", "trade_date"]).collect()
    assert [(r["event_id"], r["message"]) for r in got] == [("e0", "copies 3")]


def test_null_fields_report_counts(spark):
    df = rows(spark, {"close": None}, {"close": None, "open": None}, {})
    got = {(r["field"], r["message"]) for r in rules.null_violations(df, rules.critical_fields("normalized_equity_ohlc")).collect()}
    assert got == {("close", "2 nulls"), ("open", "1 nulls")}


def test_summary_quarantine_and_gate(spark):
    df = rows(spark, {}, {"prev_close": 80.0}, {"high": 80.0, "low": 100.0, "open": 90.0, "close": 90.0}, {})
    flagged = rules.flag(df, rules.checks_for(df, SETTINGS))
    total = outcome.summary(flagged).first()
    assert (total["total_rows"], total["valid_rows"], total["failed_rows"], total["critical_failures"], total["warnings"]) == (4, 2, 2, 5, 2)
    assert outcome.good_rows(flagged).count() == 2 and rules.FLAGS not in outcome.good_rows(flagged).columns
    q = {r["event_id"]: r for r in outcome.quarantine_rows(flagged, "normalized_equity_ohlc", AS_OF).collect()}
    assert q["e1"]["error_types"] == "warning" and q["e2"]["rules"].startswith("high_below_low,close_outside_range") and q["e1"]["retry_count"] == 0
    assert outcome.gate(outcome.summary(flagged)).first()["passed"] is False
    clean = rules.flag(rows(spark, {}), rules.checks_for(df, SETTINGS))
    assert outcome.gate(outcome.summary(clean), any_error_fails=True).first()["passed"] is True


def test_rule_sets_by_table():
    assert set(rules.rules_for_table("normalized_equity_ohlc")) == set(rules.ROW_RULES)
    general = rules.rules_for_table("symbol_master")
    assert "high_below_low" not in general and "impossible_time" in general
    assert rules.rules_for_table("symbol_master", everything=True) == rules.ROW_RULES


def test_broken_custom_rule_is_skipped(spark):
    registry = rules.Registry(predicates={"bad": lambda df: rules.Check("bad", "warning", "x", F.col("nope") > 1, F.lit(""))})
    assert registry.checks(rows(spark, {})) == [] and registry.skipped == ["bad"]


def test_schema_evolution(spark):
    old = spark.createDataFrame([], "a int, b string, c double")
    new = spark.createDataFrame([], "a bigint, c string, d string")
    assert set(shape.schema_diff(old.schema, new.schema)) == {("a", "int -> bigint", True), ("b", "removed", False), ("c", "double -> string", False), ("d", "added", True)}


def test_audit_log_reports(spark, tmp_path):
    line = '{"timestamp":"%s","schema_name":"%s","failed_rows":%d,"total_rows":%d,"rules_applied":["r1","r2"]}'
    lines = [line % ("2024-01-10T09:00:00", "a", 10, 100), line % ("2024-01-11T09:00:00", "a", 20, 100), line % ("2024-01-11T10:00:00", "b", 0, 0), "{oops", line % ("not a time", "a", 1, 1), line % ("2023-01-01T00:00:00", "a", 1, 1)]
    (tmp_path / "log.jsonl").write_text("\n".join(lines))
    entries = reports.load_audit(spark, str(tmp_path), F.lit("2024-01-12").cast("timestamp"), 30)
    assert entries.count() == 3
    report = {str(r["report_date"]): r for r in reports.daily_report(entries).collect()}
    assert report["2024-01-11"]["failure_rate"] == 0.2 and report["2024-01-11"]["schemas"] == "a,b" and report["2024-01-11"]["rules"] == "r1,r2"
    trend = {r["metric"]: r for r in reports.trends(reports.daily_report(entries)).collect()}
    assert trend["failure_rate"]["change_pct"] == pytest.approx(100.0) and trend["failure_rate"]["is_anomaly"] and trend["validation_volume"]["trend"] == "stable"
    kinds = {(str(r["report_date"]), r["kind"], r["schema_name"]) for r in reports.anomalies(entries).collect()}
    assert ("2024-01-11", "schema_rate", "a") in kinds and ("2024-01-10", "high_rate", "") in kinds and ("2024-01-11", "volume_spike", "") in kinds


def test_epoch_encodings_are_understood(spark):
    df = spark.createDataFrame(
        [("ok", 1705276800000, 1705341600000, 19737), ("bad", -1, 1705341600000, 5000)], "event_id string, event_time bigint, ingest_time bigint, trade_date int"
    )
    assert broken(df, rules.checks_for(df, SETTINGS)) == [
        ("bad", "date_out_of_range", "trade_date"), ("bad", "impossible_time", "event_time"), ("bad", "stale", "ingest_time,event_time"),
    ]


def test_required_rows(spark):
    df = rows(spark, {})
    assert outcome.require_rows(df, "bars") is df
    with pytest.raises(outcome.NoRows):
        outcome.require_rows(df.filter("false"), "bars")
