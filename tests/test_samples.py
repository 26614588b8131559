from pyspark.sql import functions as F

from ticklake.functions.finance import with_ratios
from ticklake.quality import rules
from ticklake.sources import samples


def test_sample_bars_are_valid_and_repeatable(spark):
    bars = samples.sample_bars(spark).withColumn("event_id", F.concat_ws(":", "symbol", "trade_date"))
    found = rules.violations(bars, rules.checks_for(bars, rules.Settings(as_of="2025-01-01 00:00:00")))
    assert found.count() == 0 and bars.count() == 10 * 72
    assert bars.exceptAll(samples.sample_bars(spark).withColumn("event_id", F.concat_ws(":", "symbol", "trade_date"))).count() == 0


def test_sample_macro_has_every_month(spark):
    got = samples.sample_macro(spark).groupBy("indicator_code").agg(F.count_distinct("indicator_date").alias("n")).collect()
    assert [r["n"] for r in got] == [36, 36, 36]


def test_sample_fundamentals(spark):
    row = with_ratios(samples.sample_financials(spark)).first()
    assert row["debt_to_equity"] == 0.375 and row["current_ratio"] == 1.5
    total = samples.sample_shareholding(spark).select((F.col("promoter") + F.col("public")).alias("t"))
    assert total.filter(F.abs(F.col("t") - 100) > 1e-9).count() == 0


def test_ratio_with_a_zero_side_is_null(spark):
    f = samples.sample_financials(spark, 1, 1).withColumns({"net_profit": F.lit(0.0), "current_liabilities": F.lit(None).cast("double")})
    row = with_ratios(f).first()
    assert row["roe"] is None and row["current_ratio"] is None and row["debt_to_equity"] == 0.375
