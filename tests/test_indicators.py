import datetime as dt

import pandas as pd
import pytest

from ticklake.operators import indicators as ind


def bars(spark, closes, symbol="A", start=dt.date(2024, 1, 1)):
    rows = [(symbol, start + dt.timedelta(days=i), float(c)) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "symbol string, trade_date date, close double")


def column(df, name):
    return [r[name] for r in df.orderBy("symbol", "trade_date").collect()]


def test_sma_literal_and_warm_up(spark):
    got = column(ind.sma(bars(spark, range(10, 101, 10)), windows=(5,)), "sma_5")
    assert got[:4] == [None] * 4
    assert got[4] == 30.0 and got[9] == 80.0


def test_sma_partial_has_no_warm_up(spark):
    assert column(ind.sma(bars(spark, [10, 20, 30]), windows=(5,), partial=True), "sma_5") == [10.0, 15.0, 20.0]


def test_ema_equals_recursion_over_several_blocks(spark):
    closes = [100 + (i * 37 % 101) - 50 for i in range(1300)]
    got = column(ind.emas(bars(spark, closes), spans=(12,)), "ema_12")
    want = pd.Series(closes, dtype=float).ewm(span=12, adjust=False).mean()
    assert got == pytest.approx(list(want), rel=1e-12)


def test_ema_of_short_span_does_not_overflow(spark):
    closes = [1000.0 + i for i in range(700)]
    got = column(ind.emas(bars(spark, closes), spans=(2,)), "ema_2")
    assert got == pytest.approx(list(pd.Series(closes).ewm(span=2, adjust=False).mean()), rel=1e-12)


def test_ema_leads_sma_after_a_jump(spark):
    out = ind.emas(ind.sma(bars(spark, [100] * 10 + [150] * 20), windows=(10,)), spans=(10,))
    row = out.orderBy("trade_date").collect()[14]
    assert row["ema_10"] > row["sma_10"]


def test_rsi_without_losses(spark):
    rising = bars(spark, range(1, 30))
    assert set(column(ind.rsi_smoothed(rising), "rsi_14")) == {None}
    assert set(column(ind.rsi_simple(rising), "rsi_14")) == {100.0}


def test_rsi_range(spark):
    closes = [100 + (i * 7919 % 23) for i in range(120)]
    got = [v for v in column(ind.rsi_smoothed(bars(spark, closes)), "rsi_14") if v is not None]
    assert got and all(0 <= v <= 100 for v in got)


def test_symbols_do_not_mix(spark):
    both = bars(spark, [1, 2, 3, 4, 5], "A").unionByName(bars(spark, [100, 100, 100, 100, 100], "B"))
    out = {r["symbol"]: r["sma_5"] for r in ind.sma(both, windows=(5,)).filter("sma_5 is not null").collect()}
    assert out == {"A": 3.0, "B": 100.0}


def test_features_need_their_columns(spark):
    with pytest.raises(ValueError, match="close"):
        ind.features(bars(spark, [1]).drop("close"), "v1", 0)


def test_feature_columns_in_order(spark):
    out = ind.features(bars(spark, range(1, 40)), "v7", 12)
    assert out.columns == [*ind.FEATURE_COLUMNS, "feature_version", "feature_timestamp"]
    assert out.first()["feature_version"] == "v7"


def test_serving_period_is_limited(spark):
    with pytest.raises(ValueError):
        ind.sma(bars(spark, [1]), windows=(201,), partial=True)


def test_means_of_means_need_two_sorts(spark):
    rows = bars(spark, range(1, 701))
    plan = ind.macd(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") <= 2
    full = rows.selectExpr("*", "close + 1 AS high", "close - 1 AS low", "1L AS volume")
    wide = ind.features_wide(full, "v", 1)
    assert wide._jdf.queryExecution().executedPlan().toString().count("Sort [") <= 2
    assert [c for c in wide.columns if c.startswith("_")] == []


def test_means_skip_rows_without_value_over_several_blocks(spark):
    closes = [None if i < 300 or i % 7 == 3 or 600 <= i < 1000 else 100.0 + i * 37 % 101 for i in range(1500)]
    start = dt.date(2020, 1, 1)
    df = spark.createDataFrame([("A", start + dt.timedelta(days=i), c) for i, c in enumerate(closes)], "symbol string, trade_date date, close double")
    out = ind.macd(df).orderBy("trade_date").toPandas()
    close = pd.Series(closes, dtype=float)
    want = close.ewm(span=12, adjust=False, ignore_na=True).mean() - close.ewm(span=26, adjust=False, ignore_na=True).mean()
    assert list(out["macd"])[300:] == pytest.approx(list(want)[300:], rel=1e-9, abs=1e-9) and out["macd"][:300].isna().all()
    signal = want.ewm(span=9, adjust=False, ignore_na=True).mean()
    assert list(out["macd_signal"])[300:] == pytest.approx(list(signal)[300:], rel=1e-9, abs=1e-9)
