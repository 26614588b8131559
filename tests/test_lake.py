import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ticklake.lake import files, manifest, runs
from ticklake.lake import write as lw
from ticklake.operators import calendar as cal
from ticklake.operators import stats, topk, versions
from ticklake.quality import rules


def table(spark, n=100):
    return spark.range(n).select(F.col("id").alias("k"), (F.col("id") % 4).cast("int").alias("p"), F.lit("a").alias("run"))


def test_overwrite_touches_only_present_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    lw.write_dataset(table(spark), path, ["p"])
    lw.write_dataset(table(spark).filter("p = 1").withColumn("run", F.lit("b")), path, ["p"])
    got = {(r["p"], r["run"]): r["count"] for r in spark.read.parquet(path).groupBy("p", "run").count().collect()}
    assert got == {(0, "a"): 25, (1, "b"): 25, (2, "a"): 25, (3, "a"): 25}


def test_rows_per_file_is_honoured(spark, tmp_path):
    path = str(tmp_path / "t")
    lw.write_dataset(table(spark), path, ["p"], rows_per_file=10)
    assert files.dataset_statistics(spark, path).first()["files"] == 12


def test_unknown_codec(spark, tmp_path):
    with pytest.raises(ValueError):
        lw.write_dataset(table(spark), str(tmp_path / "t"), [], codec="rar")


def test_manifest_notices_changed_and_missing_data(spark, tmp_path):
    data, marks = str(tmp_path / "d"), str(tmp_path / "m")

    def write(df=None):
        return manifest.write_once(df if df is not None else table(spark), "t", "day", data, marks, "2024-01-01 00:00:00")

    assert [write(), write()] == ["written", "skipped"]
    table(spark, 1).write.mode("append").parquet(data)
    assert write() == "written"
    assert manifest.is_complete(spark, marks, "t", "other", data) is False
    assert manifest.is_complete(spark, marks, "t", "day", str(tmp_path / "gone")) is False


def test_fingerprint_ignores_order_but_not_values(spark):
    a = manifest.fingerprint(table(spark)).first()
    assert a == manifest.fingerprint(table(spark).orderBy(F.desc("k"))).first()
    assert a != manifest.fingerprint(table(spark).withColumn("run", F.lit("z"))).first()


def test_empty_result_counts_as_done(spark, tmp_path):
    data, marks = str(tmp_path / "d"), str(tmp_path / "m")
    empty = table(spark, 0)
    assert [manifest.write_once(empty, "t", "day", data, marks, "2024-01-01 00:00:00") for _ in range(2)] == ["written", "skipped"]


@pytest.mark.parametrize("keys", [[], ["p"], ["run", "p"]])
def test_compaction_keeps_every_row(spark, tmp_path, keys):
    path, staging = str(tmp_path / "t"), str(tmp_path / "s")
    rows = table(spark, 400).repartition(5)
    (rows.write.partitionBy(*keys) if keys else rows.write).parquet(path)
    before = files.dataset_statistics(spark, path).first()["files"]
    files.compact(spark, path, staging)
    assert files.dataset_statistics(spark, path).first()["files"] < before
    assert spark.read.parquet(path).select("k", "p", "run").exceptAll(table(spark, 400)).count() == 0
    assert spark.read.parquet(path).count() == 400


def test_compaction_reads_the_planned_partitions_only(spark, tmp_path):
    """One partition of five has small files, and so has the one of the null key: the scan is pruned to these two."""
    path = str(tmp_path / "data")
    rows = spark.range(100).select("id", F.when(F.col("id") % 5 != 4, F.col("id") % 5).cast("int").alias("k"))
    rows.repartitionByRange(1, "k").write.partitionBy("k").parquet(path)
    rows.filter("k = 2 or k is null").repartition(1).write.mode("append").partitionBy("k").parquet(path)
    plan = files.compaction_plan(spark, path, 128, 32)
    assert sorted(r["partition"] for r in plan.collect()) == ["k=2", f"k={files.NULL_PARTITION}"]
    wanted = plan.select(files._folder_value("k").try_cast("int").alias("_k_k"), "target_files")
    wanted.write.parquet(str(tmp_path / "plan"))
    chosen = files._planned_rows(spark.read.parquet(path), spark.read.parquet(str(tmp_path / "plan")), ["k"])
    assert "dynamicpruning" in chosen._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["id"], r["k"]) for r in chosen.collect()) == sorted([(i, i % 5 if i % 5 != 4 else None) for i in range(100) if i % 5 in (2, 4)] * 2)
    files.compact(spark, path, str(tmp_path / "staging"))
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == sorted([*range(100), *[i for i in range(100) if i % 5 in (2, 4)]])


def test_compaction_leaves_single_files_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark).repartition("p").write.partitionBy("p").parquet(path)
    assert files.compaction_plan(spark, path, 128, 32).count() == 0


def dated(spark, tmp_path, *days):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, d) for d in days], "k int, date string").write.partitionBy("date").parquet(path)
    return path


def test_retention_is_strict_and_skips_undated(spark, tmp_path):
    path = dated(spark, tmp_path, "2024-01-01", "2024-01-11", "latest")
    as_of = F.lit("2024-01-11").cast("date")
    ages = {r["value"]: r["age_days"] for r in files.partition_ages(spark, path, "date", as_of).collect()}
    assert ages == {"2024-01-01": 10, "2024-01-11": 0, "latest": -1}
    assert files.drop_expired(spark, path, "date", as_of, 10).count() == 0
    assert [r["value"] for r in files.drop_expired(spark, path, "date", as_of, 9).collect()] == ["2024-01-01"]
    assert spark.read.parquet(path).count() == 3
    files.drop_expired(spark, path, "date", as_of, 9, dry_run=False)
    assert spark.read.parquet(path).count() == 2


def test_checked_write_can_stop(spark, tmp_path):
    df = spark.createDataFrame([("e1", 5), ("e2", -5)], "event_id string, volume bigint")
    checks = rules.checks_for(df, rules.Settings(as_of="2024-01-01 00:00:00"), ["negative_volume"])
    args = ([], checks, "t", str(tmp_path / "q"), str(tmp_path / "a"), "2024-01-01 00:00:00")
    with pytest.raises(lw.ValidationFailed):
        lw.write_checked(df, str(tmp_path / "d"), *args, fail=True)
    assert spark.read.parquet(str(tmp_path / "q")).count() == 1 and not (tmp_path / "d").exists()
    totals = lw.write_checked(df, str(tmp_path / "d"), *args)
    assert totals["total_rows"] == 2 and totals["failed_rows"] == 1
    assert [r["event_id"] for r in spark.read.parquet(str(tmp_path / "d")).collect()] == ["e1"]
    assert spark.read.json(str(tmp_path / "a")).count() == 2
    lw.write_checked(df, str(tmp_path / "all"), *args, keep_bad_rows=True)
    assert spark.read.parquet(str(tmp_path / "all")).count() == 2


def checked_run(spark, tmp_path):
    df = spark.createDataFrame([("e1", 5, 1), ("e2", -5, 1), ("e3", -7, 2), ("e4", 1, 2), ("e5", 1, 3)], "event_id string, volume bigint, p int")
    checks = rules.checks_for(df, rules.Settings(as_of="2024-01-01 00:00:00"), ["negative_volume"])
    places = [str(tmp_path / x) for x in ("d", "q", "a")]
    return df, checks, places


def test_a_repeated_run_changes_nothing(spark, tmp_path):
    df, checks, (data, bad, audit) = checked_run(spark, tmp_path)
    args = (data, ["p"], checks, "t", bad, audit, "2024-01-01 00:00:00")
    first = lw.write_checked(df, *args, run_id="r1")
    files_before = sorted(str(f) for f in tmp_path.rglob("part-*"))
    # the second call does not even look at its rows
    assert lw.write_checked(df.withColumn("volume", F.lit(1).cast("bigint")), *args, run_id="r1") == first
    assert sorted(str(f) for f in tmp_path.rglob("part-*")) == files_before
    book = runs.ledger(spark, lw.ledger_path(audit))
    assert [(r["run"], r["failed_rows"], r["outcome"]) for r in book.collect()] == [("r1", 2, "stored")]
    lw.write_checked(df.filter("event_id = 'e5'"), *args, run_id="r2")
    assert runs.ledger(spark, lw.ledger_path(audit)).count() == 2 and spark.read.parquet(data).count() == 3
    with pytest.raises(ValueError, match="run id"):
        lw.write_checked(df, *args, run_id="a/b")


def test_a_stopped_run_may_be_tried_again(spark, tmp_path):
    df, checks, (data, bad, audit) = checked_run(spark, tmp_path)
    args = (data, [], checks, "t", bad, audit, "2024-01-01 00:00:00")
    for _ in range(2):
        with pytest.raises(lw.ValidationFailed):
            lw.write_checked(df, *args, fail=True, run_id="r1")
    lw.write_checked(df, *args, run_id="r1")
    assert spark.read.parquet(bad).count() == 2 and spark.read.json(audit).count() == 1 and spark.read.parquet(data).count() == 3


def test_totals_and_reasons_of_a_checked_write(spark, tmp_path):
    """Two broken rules on one row, an unknown verdict, a column with a dot; then rules that nothing breaks, and none."""
    df = spark.createDataFrame([("e1", -5, -1, 1), ("e2", 5, 1, 2), ("e3", None, None, 3), ("e4", 0, 7, 4)], "event_id string, volume bigint, trades bigint, `a.b` int")
    settings, stamp = rules.Settings(as_of="2024-01-01 00:00:00"), "2024-01-01 00:00:00"
    trades = rules.Check("negative_trades", rules.WARNING, "trades", F.col("trades") < 0, F.lit("trades below 0"))
    checks = [*rules.checks_for(df, settings, ["negative_volume", "trades_without_volume"]), trades]

    def totals(name, checks, rows=df):
        base = str(tmp_path / name)
        got = lw.write_checked(rows, f"{base}/d", [], checks, "t", f"{base}/q", f"{base}/a", stamp, run_id="r1")
        return tuple(got[c] for c in runs.TOTALS), spark.read.parquet(f"{base}/d").count(), spark.read.parquet(f"{base}/q").count()

    assert totals("some", checks) == ((4, 2, 2, 3, 1), 2, 2)
    bad = {r["event_id"]: (r["rules"], r["error_types"], r["a.b"]) for r in spark.read.parquet(str(tmp_path / "some" / "q")).collect()}
    assert bad == {"e1": ("negative_volume,negative_trades", "critical,warning", 1), "e4": ("trades_without_volume", "critical", 4)}
    assert totals("good", checks, df.filter("event_id = 'e2'")) == ((1, 1, 0, 0, 0), 1, 0)
    assert totals("unchecked", []) == ((4, 4, 0, 0, 0), 4, 0)
    always = [rules.Check("always", rules.CRITICAL, "volume", F.lit(True), F.lit("bad"))]
    assert totals("all", always) == ((4, 0, 4, 4, 0), 0, 4)


def test_rows_of_a_run_without_ledger_row_are_not_visible(spark, tmp_path):
    df, checks, (data, bad, audit) = checked_run(spark, tmp_path)
    lw.write_checked(df, data, [], checks, "t", bad, audit, "2024-01-01 00:00:00", run_id="r1")
    spark.read.parquet(f"{bad}/run=r1").write.parquet(f"{bad}/run=broken")
    book = runs.ledger(spark, lw.ledger_path(audit))
    assert spark.read.parquet(bad).count() == 4 and runs.visible(spark.read.parquet(bad), book).count() == 2


@pytest.mark.parametrize("partitions", [[], ["p"]])
def test_replay_is_keyed_by_its_run(spark, tmp_path, partitions):
    df, checks, (data, bad, audit) = checked_run(spark, tmp_path)
    stamp = "2024-01-01 00:00:00"
    with pytest.raises(ValueError, match="not been committed"):
        lw.replay_run(spark, "r1", "f1", df, "event_id", data, partitions, checks, "t", bad, audit, stamp)
    lw.write_checked(df, data, partitions, checks, "t", bad, audit, stamp, run_id="r1")
    fixes = spark.createDataFrame([("e2", 50)], "event_id string, volume bigint")
    untouched = sorted((tmp_path / "d").glob("p=3/part-*"))
    for _ in range(2):
        totals = lw.replay_run(spark, "r1", "f1", fixes, "event_id", data, partitions, checks, "t", bad, audit, stamp)
        assert totals["total_rows"] == 2 and totals["failed_rows"] == 1
    assert sorted((r["event_id"], r["volume"]) for r in spark.read.parquet(data).collect()) == [("e1", 5), ("e2", 50), ("e4", 1), ("e5", 1)]
    assert sorted((tmp_path / "d").glob("p=3/part-*")) == untouched
    left = runs.still_open(spark.read.parquet(bad), runs.ledger(spark, lw.ledger_path(audit))).collect()
    assert [(r["event_id"], r["retry_count"], r["run"]) for r in left] == [("e3", 1, "r1~f1")]
    lw.replay_run(spark, "r1~f1", "f2", fixes.withColumn("event_id", F.lit("e3")), "event_id", data, partitions, checks, "t", bad, audit, stamp)
    assert spark.read.parquet(data).count() == 5
    assert runs.still_open(spark.read.parquet(bad), runs.ledger(spark, lw.ledger_path(audit))).count() == 0


def test_serving_load_needs_its_columns(spark):
    df = spark.createDataFrame([("A", "2024-01-01", 1704067200000)], "symbol string, trade_date string, event_time bigint")
    with pytest.raises(ValueError, match="ClsPric"):
        lw.prepare_for_serving(df, ["TckrSymb", "ClsPric"])
    row = lw.prepare_for_serving(df, ["TckrSymb"], date_cols=("TradDt",), ms_cols=("event_time",)).first()
    assert row["TradDt"] == dt.date(2024, 1, 1) and row["event_time"] == dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("partitions", [[], ["year"]])
def test_replay_adds_new_rows_and_rewrites_only_where_one_is_replaced(spark, tmp_path, partitions):
    data = str(tmp_path / "data")
    rows = lambda *r: spark.createDataFrame([*r], "event_id string, volume long, year int")
    lw.write_dataset(rows(("a", 1, 2020), ("b", 2, 2021), ("c", 3, None), (None, 4, 2020)), data, partitions)
    files_now = lambda: {str(f) for f in (tmp_path / "data").rglob("*.parquet")}
    first = files_now()

    def put(n, *accepted):
        stored = spark.read.parquet(data)
        lw._put(spark, stored, rows(*accepted).select(*stored.columns), "event_id", data, partitions, str(tmp_path / f"staged-{n}"))
        found = spark.read.parquet(data).select("event_id", "volume", "year").collect()
        return sorted(map(tuple, found), key=str)

    with_new = [("a", 1, 2020), ("b", 2, 2021), ("c", 3, None), ("n", 5, 2020), ("o", 6, None), (None, 4, 2020), (None, 7, 2022)]
    assert put(1, ("n", 5, 2020), ("o", 6, None), (None, 7, 2022)) == sorted(with_new, key=str)
    assert first < files_now()
    # a replay that broke off is repeated: its rows are there once
    assert put(2, ("n", 50, 2020), ("p", 8, 2021)) == sorted([("n", 50, 2020) if r[0] == "n" else r for r in with_new] + [("p", 8, 2021)], key=str)
    if partitions:
        assert {f for f in first if "year=2020" not in f} < files_now() and not {f for f in first if "year=2020" in f} & files_now()


def test_scd2_merge_closes_opens_and_keeps(spark):
    h = spark.createDataFrame([("a", "x", dt.date(2023, 1, 1), None), ("b", "y", dt.date(2023, 1, 1), None), ("c", None, dt.date(2023, 1, 1), None)], "symbol string, status string, valid_from date, valid_to date")
    batch = spark.createDataFrame([("a", "z"), ("c", None), ("d", "n")], "symbol string, status string")
    got = versions.scd2_merge(h, batch, "symbol", F.lit("2024-01-01").cast("date"), ["status"]).collect()
    assert sorted((r["symbol"], r["status"] or "", r["is_current"]) for r in got) == [("a", "x", False), ("a", "z", True), ("b", "y", True), ("c", "", True), ("d", "n", True)]


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


VERSION_ROWS = "symbol string, status string, valid_from date, valid_to date"


def merged(spark, history, changes):
    h = spark.createDataFrame([(k, s, day(a), None if b is None else day(b)) for k, s, a, b in history], VERSION_ROWS)
    c = spark.createDataFrame([(k, s, day(a)) for k, s, a in changes], "symbol string, status string, at date")
    out = versions.scd2_merge(h, c, "symbol", F.col("at"), ["status"]).collect()
    number = lambda d: None if d is None else (d - day(0)).days
    assert all(r["is_current"] == (r["valid_to"] is None) for r in out)
    return sorted(((r["symbol"], r["status"], number(r["valid_from"]), number(r["valid_to"])) for r in out), key=str)


@pytest.mark.parametrize(
    ("history", "changes", "want"),
    [
        ([("a", "x", 10, None)], [("a", "z", 5)], [("a", "x", 10, None), ("a", "z", 5, 10)]),  # before all versions
        ([("a", "x", 10, None)], [("a", "x", 5)], [("a", "x", 5, None)]),  # the same value, known earlier
        ([("a", "x", 0, 10), ("a", "y", 10, None)], [("a", "z", 4)], [("a", "x", 0, 4), ("a", "y", 10, None), ("a", "z", 4, 10)]),  # splits a closed version
        ([("a", "x", 0, 10), ("a", "y", 10, None)], [("a", "y", 4)], [("a", "x", 0, 4), ("a", "y", 4, None)]),  # shortens one, extends the next
        ([("a", "x", 0, 10), ("a", "y", 10, None)], [("a", "z", 10)], [("a", "x", 0, 10), ("a", "z", 10, None)]),  # replaces what starts that day
        ([("a", "x", 0, 10), ("a", "y", 10, None)], [("a", "x", 10)], [("a", "x", 0, None)]),
        ([("a", "x", 0, 5), ("a", "y", 8, None)], [("a", "z", 6)], [("a", "x", 0, 5), ("a", "y", 8, None), ("a", "z", 6, 8)]),  # into a gap
        ([("a", "x", 0, 5), ("a", "y", 8, None)], [("a", "z", 2)], [("a", "x", 0, 2), ("a", "y", 8, None), ("a", "z", 2, 5)]),  # a gap stays
        ([("a", "x", 0, 5)], [("a", "z", 9)], [("a", "x", 0, 5), ("a", "z", 9, None)]),  # after a closed end
        ([("a", "x", 0, None), ("b", None, 3, None)], [("c", "n", 1), ("b", None, 1), ("a", "y", 4), ("a", "z", 2)], [("a", "x", 0, 2), ("a", "y", 4, None), ("a", "z", 2, 4), ("b", None, 1, None), ("c", "n", 1, None)]),
        ([], [], []),
    ],
)
def test_scd2_changes_in_any_order(spark, history, changes, want):
    assert merged(spark, history, changes) == sorted(want, key=str)


def test_scd2_merge_reads_the_history_once_and_sorts_its_events_once(spark):
    h = spark.createDataFrame([("a", "x", day(0), None)], VERSION_ROWS)
    c = spark.createDataFrame([("a", "y", day(5))], "symbol string, status string, at date")
    out = versions.scd2_merge(h, c, "symbol", F.col("at"), ["status"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    # one sort for the ends of the history, one for all events
    assert plan.count("Scan ExistingRDD") == 2 and plan.count("Sort [") == 2


def test_scd2_ends_of_overlapping_versions(spark):
    """A version that the next one covers has no end of its own."""
    history = [("a", "x", 0, 10), ("a", "y", 5, 10), ("b", "x", 0, 10), ("b", "y", 5, 8)]
    assert merged(spark, history, []) == [("a", "x", 0, 5), ("a", "y", 5, 10), ("b", "x", 0, 5), ("b", "y", 5, 8)]


def test_scd2_batches_equal_a_plain_rebuild(spark):
    """Batch by batch in any order: what the history has and the batch brings, sorted, equal neighbours as one."""
    rng = random.Random(4)
    changes = [("k" + str(k), rng.choice("xyz"), d) for k in range(5) for d in rng.sample(range(100), 20)]
    rng.shuffle(changes)
    history, plain = [], {}
    for k in range(0, len(changes), 25):
        batch = changes[k : k + 25]
        history = [tuple(r) for r in merged(spark, history, batch)]
        for key, status, d in batch:
            plain.setdefault(key, {})[d] = status
        for key, known in plain.items():
            kept = {}
            for d in sorted(known):
                if not kept or kept[max(kept)] != known[d]:
                    kept[d] = known[d]
            plain[key] = kept
        want = [(key, known[d], d, min((x for x in known if x > d), default=None)) for key, known in plain.items() for d in known]
        assert history == sorted(want, key=str)


def test_point_in_time_respects_gaps(spark):
    v = spark.createDataFrame([("a", "x", dt.date(2023, 1, 1), dt.date(2023, 6, 1)), ("a", "y", dt.date(2023, 9, 1), None)], "symbol string, status string, valid_from date, valid_to date")
    f = spark.createDataFrame([("a", d) for d in (dt.date(2022, 1, 1), dt.date(2023, 1, 1), dt.date(2023, 6, 1), dt.date(2024, 1, 1))], "symbol string, d date")
    got = [r["status"] for r in versions.point_in_time(f, v, "symbol", "d", ["status"]).orderBy("d").collect()]
    assert got == [None, "x", None, "y"]


def test_membership_replays_removals(spark):
    e = spark.createDataFrame([("I", "A", dt.date(2024, 1, 1), "ADD"), ("I", "A", dt.date(2024, 3, 1), "REMOVE"), ("I", "B", dt.date(2024, 2, 1), "ADD")], "index_name string, symbol string, effective_date date, action string")
    at = lambda d: sorted(r["symbol"] for r in versions.membership(e, ["index_name", "symbol"], F.lit(d).cast("date"), ["action"]).collect())
    assert (at("2024-02-15"), at("2024-03-01"), at("2023-01-01")) == (["A", "B"], ["B"], [])


def test_trading_day_shift_limits_its_search(spark):
    span = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 12, 31))], "first date, last date")
    none = spark.createDataFrame([], "mm int, dd int, holiday_name string")
    c = cal.build_calendar(span, none)
    long_stop = c.withColumn("is_trading_day", F.col("is_trading_day") & ~F.col("trade_date").between("2024-03-02", "2024-05-15"))
    got = {str(r["trade_date"]): r["shifted"] for r in cal.trading_day_shift(long_stop, 1).collect()}
    assert str(got["2024-01-05"]) == "2024-01-08" and got["2024-03-01"] is None and str(got["2024-04-01"]) == "2024-05-16"


def test_calendar_holiday_beats_weekend_and_unknown_dates_fall_back(spark):
    span = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 2))], "first date, last date")
    hol = spark.createDataFrame([(1, 6, "Saturday feast"), (1, 26, "Republic Day")], "mm int, dd int, holiday_name string")
    c = cal.build_calendar(span, hol)
    days = {str(r["trade_date"]): r["day_type"] for r in c.collect()}
    assert len(days) == 366 and days["2024-01-06"] == "MARKET_HOLIDAY" and days["2024-01-07"] == "WEEKEND" and days["2024-01-08"] == "NORMAL_TRADING"
    q = spark.createDataFrame([(dt.date(2024, 1, 26),), (dt.date(2025, 3, 3),), (dt.date(2025, 3, 2),)], "d date")
    assert {str(r["d"]): r["is_trading_day"] for r in cal.with_trading_flag(q, "d", c).collect()} == {"2024-01-26": False, "2025-03-03": True, "2025-03-02": False}


@pytest.mark.parametrize("text,minutes", [("5m", 5.0), ("1h", 60.0), ("30s", 0.5)])
def test_intervals(text, minutes):
    assert cal.interval_minutes(text) == minutes


def test_interval_text_is_checked():
    with pytest.raises(ValueError):
        cal.interval_minutes("5 weeks")


def test_exact_median_on_skewed_groups(spark):
    df = spark.range(5001).select(F.when(F.col("id") % 7 == 0, "small").otherwise("big").alias("g"), ((F.col("id") * 7919) % 1009).cast("double").alias("v"))
    got = {r["g"]: r["median"] for r in stats.exact_median(df, ["g"], "v").collect()}
    want = df.toPandas().groupby("g")["v"].median().to_dict()
    assert got == want


def test_exact_quantiles_of_hot_null_and_single_groups(spark):
    rng = random.Random(9)
    rows = [("hot", float(rng.randrange(400))) for _ in range(3000)] + [(f"g{k % 40}", rng.random()) for k in range(900)]
    rows += [("one", 3.5), ("none", None), ("none", None), (None, 1.0), (None, 2.0), ("hot", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    wanted = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r["g"]: r["quantiles"] for r in stats.exact_quantiles(df, ["g"], "v", wanted).collect()}
    assert got.pop("none") == [None] * 5 and got.pop("one") == [3.5] * 5
    frame = pd.DataFrame(rows, columns=["g", "v"])
    for g, values in got.items():
        mine = frame[frame["g"].isna() if g is None else frame["g"] == g]["v"].dropna()
        assert values == pytest.approx(list(mine.quantile(wanted))), g
    assert len(got) == 42


def test_a_hot_group_is_sorted_by_many_tasks(spark, monkeypatch):
    """A group with nearly all rows: its ranks come from several partitions."""
    df = spark.range(200_000).select(F.lit("hot").alias("g"), ((F.col("id") * 7919) % 199_999).cast("double").alias("v"))
    seen = []
    real = stats.fresh_path
    monkeypatch.setattr(stats, "fresh_path", lambda s, label: seen.append(real(s, label)) or seen[-1])
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        row = stats.exact_quantiles(df, ["g"], "v", [0.5]).first()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    sizes = [r["count"] for r in spark.read.parquet(seen[0]).groupBy(F.shiftright("_at", 33)).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 0.6 * sum(sizes)
    assert row["quantiles"] == [df.toPandas()["v"].median()]


def test_pages_are_checked(spark):
    with pytest.raises(ValueError):
        topk.page(table(spark), [F.col("k")], 0, 10)
    assert [r["k"] for r in topk.page(table(spark), [F.col("k")], 2, 3).collect()] == [3, 4, 5]
    assert [r["k"] for r in topk.page_after(table(spark), "k", 96, 10).collect()] == [97, 98, 99]


def test_compaction_to_many_small_files_needs_few_tasks(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(4000).select("id", (F.col("id") % 2).cast("int").alias("p"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("a b/"), F.col("id") % 3)).alias("q"))
    rows.repartition(3).write.partitionBy("p", "q").parquet(path)
    spark.sparkContext.setJobGroup("compaction", "compaction")
    plan = files.compact(spark, path, str(tmp_path / "s"), target_mb=0.0002)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    want = {r["partition"]: r["target_files"] for r in plan.collect()}
    got = {r["partition"]: r["n"] for r in files.list_files(spark, path).groupBy("partition").agg(F.count("*").alias("n")).collect()}
    assert got == want and sum(want.values()) > 100
    status = spark.sparkContext.statusTracker()
    tasks = [status.getStageInfo(s).numTasks for j in status.getJobIdsForGroup("compaction") for s in status.getJobInfo(j).stageIds if status.getStageInfo(s)]
    assert max(tasks) < 20
    assert spark.read.parquet(path).select(*rows.columns).exceptAll(rows).isEmpty() and spark.read.parquet(path).count() == 4000
    assert not [x for x in (tmp_path / "t").iterdir() if x.name.startswith(".compaction")]
