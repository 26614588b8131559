"""What the physical plans must and must not contain."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from ticklake import session
from ticklake.bridge import Market
from ticklake.lake import write as lw
from ticklake.operators.asof import asof_join
from ticklake.operators.indicators import features
from ticklake.plans.registry import QUERIES


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def tree(df):
    return plan(df).split("\n\n")[0]


STREAMS = ("str", "src24", "snk")
BATCH = sorted(n for n in QUERIES if not n.startswith(STREAMS))


@pytest.mark.parametrize("name", BATCH)
def test_no_cartesian_products_and_no_row_python(name, spark, sf):
    text = tree(entry_module.queries()[name](spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    assert ("MapInPandas" in text) == (name == "src15_xbrl_records")


def test_features_share_one_exchange_on_symbol(spark, sf):
    bars = Market(spark, sf).closes
    before, after = tree(bars).count("Exchange"), tree(features(bars, "v1", 0)).count("Exchange")
    assert after == before + 1


def test_adjusted_features_reuse_the_asof_partitioning(spark, sf):
    text = plan(entry_module.queries()["flagship_adjusted_features"](spark, sf))
    assert text.count("hashpartitioning(_k_symbol") == 1


def test_nearest_is_one_exchange_on_the_key(spark, sf):
    market = Market(spark, sf)
    left = market.financials.select("symbol", "period_end_date", "eps")
    right = market.closes.withColumn("at", F.col("trade_date"))
    joined = asof_join(left, right, ["symbol"], "period_end_date", "at", ["close"], "nearest")
    text = plan(joined)
    assert text.count("hashpartitioning(_k_symbol") == 1 and tree(joined).count("Union") == 1


def test_raw_and_adjusted_bars_are_built_once(spark, sf):
    text = tree(entry_module.queries()["join20_raw_vs_adjusted"](spark, sf))
    assert "Join" not in text.replace("BroadcastHashJoin", "") and text.count("lineitem") <= 2


def test_slices_reach_the_scan(spark, sf):
    text = plan(entry_module.queries()["prj10_price_slice"](spark, sf))
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line)
    assert "l_shipdate" in pushed and "l_suppkey" in pushed


def test_closes_read_only_their_columns(spark, sf):
    text = plan(Market(spark, sf).closes)
    schema = next(line for line in text.splitlines() if "ReadSchema" in line)
    assert "l_discount" not in schema and "l_returnflag" not in schema


def test_bars_are_hash_aggregated(spark, sf):
    assert "SortAggregate" not in tree(Market(spark, sf).ohlc)


def test_top_k_is_limited_before_the_shuffle(spark, sf):
    text = tree(entry_module.queries()["win13_volume_leaders_per_day"](spark, sf))
    assert text.count("WindowGroupLimit") == 2


def test_tries_of_a_checked_write_build_no_bars(spark, sf, monkeypatch):
    """A stopped run, its second try and the write behind it read bars that were stored once."""
    inputs, write = [], lw.write_checked
    monkeypatch.setattr(lw, "write_checked", lambda df, *args, **more: inputs.append(tree(df)) or write(df, *args, **more))
    QUERIES["snk15_quarantine_and_audit"](spark, sf)
    assert len(inputs) == 2 and not any("Aggregate" in text or "Exchange" in text for text in inputs)


def test_late_merge_keeps_its_number_of_tasks(spark, sf):
    """Its stage reads one small shuffle several times, which would be merged into a few large tasks."""
    assert "REPARTITION_BY_NUM" in plan(QUERIES["join12_scd2_late_merge"](spark, sf))


def test_nearest_reads_no_key_again_for_every_row(spark, sf):
    text = plan(QUERIES["join04_asof_nearest"](spark, sf))
    assert "unboundedfollowing" not in text.lower() and text.lower().count("lead(") > 0


def test_nearest_looks_past_rows_without_a_right_side(spark):
    left = spark.createDataFrame([("a", t, i) for i, t in enumerate((1, 4, 4, 6, 9, None))] + [("b", 5, 6), (None, 5, 7)], "k string, d int, i int")
    right = spark.createDataFrame([("a", 4, "at"), ("a", 8, "after"), (None, 5, "none")], "k string, e int, v string")
    day = lambda c: F.date_add(F.lit("2024-01-01").cast("date"), F.col(c))
    out = asof_join(left.withColumn("d", day("d")), right.withColumn("e", day("e")), ["k"], "d", "e", ["v"], "nearest").collect()
    assert {r["i"]: r["v"] for r in out} == {0: "at", 1: "at", 2: "at", 3: "at", 4: "after", 5: None, 6: None, 7: None}


@pytest.mark.parametrize("name", ["agg07_symbol_activity", "agg08_deals_by_client"])
def test_deals_are_dealt_by_rows(name, spark, sf, monkeypatch):
    """No task of the join gets more line items than a task may hold, whatever the number of shuffle partitions."""
    lines = Market(spark, sf).lines
    monkeypatch.setattr(session, "ROWS_PER_TASK", lines // 50)
    keys = {"agg07_symbol_activity": ["l_orderkey", "symbol"], "agg08_deals_by_client": ["l_orderkey"]}[name]
    text = plan(QUERIES[name](spark, sf))
    for key in keys:
        assert re.search(rf"hashpartitioning\({key}#[^\n]*, 5[0-9]\), REPARTITION_BY_NUM", text)


def test_defects_are_planted_in_bars_built_once(spark, sf):
    assert tree(Market(spark, sf).dirty).count("Scan parquet") == 1
