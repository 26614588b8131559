import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ticklake.functions import actions as act
from ticklake.operators.adjust import adjust_prices, cumulative_factors

D = dt.date


def factors(spark, *rows):
    return cumulative_factors(spark.createDataFrame(rows, "symbol string, ex_date date, action_type string, adjustment_factor double"))


def prices(spark, *rows):
    return spark.createDataFrame(rows, "symbol string, trade_date date, close double, volume bigint")


def closes(df):
    return {(r["symbol"], r["trade_date"]): r["close"] for r in df.collect()}


def test_split_and_bonus_literals(spark):
    f = factors(spark, ("A", D(2024, 1, 15), "SPLIT", 5.0), ("B", D(2024, 1, 15), "BONUS", 1.5))
    p = prices(spark, ("A", D(2024, 1, 14), 2520.0, 10), ("A", D(2024, 1, 15), 510.0, 10), ("B", D(2024, 1, 10), 3650.0, 10), ("C", D(2024, 1, 1), 7.0, 1))
    got = closes(adjust_prices(p, f))
    assert got[("A", D(2024, 1, 14))] == 504.0
    assert got[("A", D(2024, 1, 15))] == 510.0
    assert got[("B", D(2024, 1, 10))] == pytest.approx(2433.3333, abs=1e-4)
    assert got[("C", D(2024, 1, 1))] == 7.0


def test_several_events_compound_once(spark):
    f = factors(spark, ("A", D(2024, 2, 1), "SPLIT", 5.0), ("A", D(2024, 3, 1), "BONUS", 1.5))
    p = prices(spark, ("A", D(2024, 1, 1), 750.0, 1), ("A", D(2024, 2, 10), 150.0, 1), ("A", D(2024, 3, 5), 100.0, 1))
    assert sorted(closes(adjust_prices(p, f)).values()) == [100.0, 100.0, 100.0]
    assert closes(adjust_prices(p, f, mode="product_of_cumulative"))[("A", D(2024, 1, 1))] == pytest.approx(750.0 / (1.5 * 7.5))


def test_two_events_on_one_day(spark):
    f = factors(spark, ("A", D(2024, 2, 1), "SPLIT", 2.0), ("A", D(2024, 2, 1), "BONUS", 1.5))
    assert list(closes(adjust_prices(prices(spark, ("A", D(2024, 1, 1), 30.0, 1)), f)).values()) == [10.0]


def test_inclusive_counts_the_ex_date(spark):
    f = factors(spark, ("A", D(2024, 2, 1), "SPLIT", 2.0))
    p = prices(spark, ("A", D(2024, 2, 1), 30.0, 1))
    assert list(closes(adjust_prices(p, f)).values()) == [30.0]
    assert list(closes(adjust_prices(p, f, inclusive=True)).values()) == [15.0]


def test_duplicate_price_rows_get_the_same_factor(spark):
    f = factors(spark, ("A", D(2024, 2, 1), "SPLIT", 2.0))
    p = prices(spark, ("A", D(2024, 1, 1), 30.0, 1), ("A", D(2024, 1, 1), 30.0, 1))
    assert [r["close"] for r in adjust_prices(p, f).collect()] == [15.0, 15.0]


def test_volume_is_untouched(spark):
    f = factors(spark, ("A", D(2024, 2, 1), "SPLIT", 2.0))
    assert adjust_prices(prices(spark, ("A", D(2024, 1, 1), 30.0, 77)), f).first()["volume"] == 77


@pytest.mark.parametrize(
    "purpose,kind,factor",
    [
        ("Stock Split From Rs 10/- to Rs 2/- Per Share", "SPLIT", 5.0),
        ("Sub-Division from Rs. 10/- to Rs. 1/-", "SPLIT", 10.0),
        ("Bonus issue 1:2", "BONUS", 1.5),
        ("1 for 1 Bonus", "BONUS", 2.0),
        ("Final Dividend - Rs 10 per share", "DIVIDEND", 1.0),
        ("Interest payment", "INTEREST_PAYMENT", 1.0),
        ("Demerger", "DEMERGER", 1.0),
        ("Scheme of merger", "MERGER", 1.0),
        ("Consolidation of units", "OTHER", 1.0),
        (None, None, 1.0),
    ],
)
def test_purpose_texts(spark, purpose, kind, factor):
    df = spark.createDataFrame([(purpose,)], "p string")
    row = df.select(act.action_type(F.col("p")).alias("k"), act.text_factor(act.action_type(F.col("p")), F.col("p")).alias("f")).first()
    assert (row["k"], row["f"]) == (kind, factor)


def test_factor_arguments_are_checked(spark):
    df = spark.createDataFrame([(0.0, 5.0)], "old double, new double")
    with pytest.raises(PySparkException):
        df.select(act.split_factor(F.col("old"), F.col("new"))).collect()
    assert df.select(act.split_factor(F.col("old"), F.col("new"), strict=False)).first()[0] is None
