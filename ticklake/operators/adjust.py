"""Price adjustment for corporate actions.

Events are few per symbol; prices are many.  Every mode is one forward as-of join from each price
row to the next event, so no price row is multiplied.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticklake.operators.asof import asof_join

PRICE_COLUMNS = ("open", "high", "low", "close", "last_price", "prev_close")


def cumulative_factors(ca: DataFrame) -> DataFrame:
    """Product of a symbol's factors from its latest event back to each event.

    A factor that is missing, zero or negative is an error of that event alone (``factor_violations``): it counts
    as 1 and the symbol's other events stay in force.
    """
    w = (
        Window.partitionBy("symbol")
        .orderBy(F.col("ex_date").desc(), "action_type")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return ca.withColumn("cumulative_factor", F.coalesce(F.product(F.when(F.col("adjustment_factor") > 0, F.col("adjustment_factor"))).over(w), F.lit(1.0)))


def factor_violations(ca: DataFrame) -> DataFrame:
    """Events whose factor cannot adjust a price."""
    return ca.filter(F.col("adjustment_factor").isNull() | (F.col("adjustment_factor") <= 0))


def _per_date(factors: DataFrame, mode: str) -> DataFrame:
    """One factor per (symbol, ex_date): what a price just before that date is divided by."""
    if mode == "product_of_cumulative":
        w = Window.partitionBy("symbol").orderBy(F.col("ex_date").desc()).rowsBetween(Window.unboundedPreceding, 0)
        daily = factors.groupBy("symbol", "ex_date").agg(F.product("cumulative_factor").alias("_f"))
        return daily.select("symbol", "ex_date", F.product("_f").over(w).alias("factor"))
    # events of one day compound, so the day's factor is the one furthest along the product
    w = Window.partitionBy("symbol", "ex_date").orderBy(F.col("action_type").desc())
    return (
        factors.withColumn("_r", F.row_number().over(w))
        .filter("_r = 1")
        .select("symbol", "ex_date", F.col("cumulative_factor").alias("factor"))
    )


def adjust_prices(
    prices: DataFrame, factors: DataFrame, mode: str = "next_cumulative", inclusive: bool = False
) -> DataFrame:
    """Divide price columns by the factor of the events after each trade date.

    ``next_cumulative`` divides by the cumulative factor of the next event; this is the default.
    ``product_of_cumulative`` multiplies the cumulative factors of all later events, as some
    published histories do; its date is the symbol's last event, past or not.  ``inclusive`` also counts an event on
    the trade date itself.  Rows without a later event keep their price and get factor 1.
    """
    if mode not in ("next_cumulative", "product_of_cumulative"):
        raise ValueError(f"unknown mode {mode}")
    per_date = _per_date(factors, mode).withColumn("stamp", F.col("ex_date"))
    found = asof_join(
        prices, per_date, ["symbol"], "trade_date", "ex_date", ["factor", "stamp"], direction="forward", allow_exact=inclusive
    )
    if mode == "product_of_cumulative":
        last = factors.groupBy("symbol").agg(F.max("ex_date").alias("stamp"))
        found = found.drop("stamp").join(last, "symbol", "left")
    factor = F.coalesce(F.col("factor"), F.lit(1.0))
    touched = {c: F.try_divide(F.col(c), factor) for c in PRICE_COLUMNS if c in prices.columns}
    out = found.withColumns({**touched, "adjustment_factor": factor, "adjustment_date": F.col("stamp")})
    return out.drop("factor", "stamp")
