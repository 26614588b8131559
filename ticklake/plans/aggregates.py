"""AGG, SORT, SET: aggregations, ordering and set operations."""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticklake.bridge import with_sql
from ticklake.functions.rounding import r2, r4, sql2, sql4
from ticklake.operators import stats, topk
from ticklake.operators.adjust import cumulative_factors
from ticklake.operators.candles import candles, week_from_monday, week_from_sunday
from ticklake.operators.dedupe import duplicate_keys, first_nonempty
from ticklake.operators.indicators import rsi_simple
from ticklake.operators.versions import membership
from ticklake.plans.joins import calendar_of
from ticklake.plans.registry import query
from ticklake.session import dealt

B = "BIGINT"


def isum(expr: str) -> str:
    return f"CAST(sum({expr}) AS BIGINT)"


def icount_if(expr: str) -> str:
    return f"count(*) FILTER (WHERE {expr})"


@query(
    "agg01_product_per_key",
    with_sql("ca", body=f"SELECT symbol, {sql4('product(adjustment_factor)')} AS factor, count(*) AS events FROM ca GROUP BY 1"),
)
def _(m):
    return m.ca.groupBy("symbol").agg(r4(F.product("adjustment_factor")).alias("factor"), F.count("*").alias("events"))


def candle_sql(start: str) -> str:
    return with_sql("ohlc", body=f"""SELECT symbol, {start} AS period_start, {sql4("arg_min(open, trade_date)")} AS open, {sql4("max(high)")} AS high,
 {sql4("min(low)")} AS low, {sql4("arg_max(close, trade_date)")} AS close, {isum("volume")} AS volume FROM ohlc GROUP BY ALL""")


def rounded_candles(m, interval):
    return candles(m.ohlc, interval).withColumns({c: r4(c) for c in ("open", "high", "low", "close")})


@query("agg02_weekly_candles", candle_sql("trade_date - CAST(dayofweek(trade_date) AS INTEGER)"))
def _(m):
    return rounded_candles(m, "1w")


@query("agg03_monthly_candles", candle_sql("CAST(date_trunc('month', trade_date) AS DATE)"))
def _(m):
    return rounded_candles(m, "1M")


@query(
    "agg04_daily_market",
    with_sql("ohlc", body=f"""SELECT trade_date, count(DISTINCT symbol) AS symbols, {isum("volume")} AS volume, {sql2("sum(turnover)")} AS turnover,
 {sql4("avg(close)")} AS avg_close, {sql4("max(high)")} AS max_high, {sql4("min(low)")} AS min_low FROM ohlc GROUP BY 1"""),
)
def _(m):
    # bars are unique per (symbol, day), so distinct symbols per day is a plain count
    return m.ohlc.groupBy("trade_date").agg(
        F.count("symbol").alias("symbols"), F.sum("volume").alias("volume"), r2(F.sum("turnover")).alias("turnover"),
        r4(F.avg("close")).alias("avg_close"), r4(F.max("high")).alias("max_high"), r4(F.min("low")).alias("min_low"),
    )


@query("agg04_daily_market_approximate")
def _(m):
    """Sketch-sized distinct counts for raw trades, where exact ones would shuffle every symbol."""
    return m.trades.groupBy("trade_date").agg(
        F.approx_count_distinct("symbol", 0.02).alias("symbols"), F.count("*").alias("trades")
    )


@query(
    "agg04_approximate_error_band",
    with_sql("trades", body="""SELECT CAST(year(trade_date) AS INTEGER) AS year, count(*) AS days, count(*) AS days_in_band, CAST(sum(symbols) AS BIGINT) AS symbol_days
 FROM (SELECT trade_date, count(DISTINCT symbol) AS symbols FROM trades GROUP BY 1) GROUP BY 1"""),
)
def _(m):
    """Per year the days whose sketched number of symbols lies within five standard errors of the exact one."""
    error = 0.02
    per = m.trades.groupBy("trade_date", "symbol").agg(F.lit(1).alias("one")).groupBy("trade_date").agg(
        F.count("*").alias("symbols"), F.approx_count_distinct("symbol", error).alias("sketched")
    )
    close = F.abs(F.col("sketched") - F.col("symbols")) <= 5 * error * F.col("symbols")
    return per.groupBy(F.year("trade_date").alias("year")).agg(
        F.count("*").alias("days"), F.count_if(close).alias("days_in_band"), F.sum("symbols").alias("symbol_days")
    )


@query(
    "agg05_top_symbols",
    with_sql("ohlc", body=f"""SELECT symbol, {isum("volume")} AS total_volume, {sql4("avg(close)")} AS avg_price FROM ohlc
 GROUP BY 1 ORDER BY total_volume DESC, symbol LIMIT 10"""),
)
def _(m):
    per = m.ohlc.groupBy("symbol").agg(F.sum("volume").alias("total_volume"), r4(F.avg("close")).alias("avg_price"))
    return per.orderBy(F.desc("total_volume"), "symbol").limit(10)


@query(
    "agg06_conditional_counts",
    with_sql("ohlc", body=f"""SELECT count(*) AS total_rows, {icount_if("high >= low")} AS valid_rows, {icount_if("high < low")} AS invalid_rows,
 {icount_if("open = close")} AS flat_rows, {icount_if("close IS NULL")} AS null_close FROM ohlc"""),
)
def _(m):
    return m.ohlc.agg(
        F.count("*").alias("total_rows"), F.count_if(F.col("high") >= F.col("low")).alias("valid_rows"),
        F.count_if(F.col("high") < F.col("low")).alias("invalid_rows"), F.count_if(F.col("open") == F.col("close")).alias("flat_rows"),
        F.count_if(F.col("close").isNull()).alias("null_close"),
    )


def buy(c):
    return F.sum(F.when(F.col("transaction_type") == "BUY", F.col(c)).otherwise(0))


def sell(c):
    return F.sum(F.when(F.col("transaction_type") == "SELL", F.col(c)).otherwise(0))


def sql_if(kind, c):
    return f"sum(CASE WHEN transaction_type = '{kind}' THEN {c} ELSE 0 END)"


@query(
    "agg07_deals_by_type",
    with_sql("deals", body=f"""SELECT deal_type, count(*) AS total_deals, count(DISTINCT symbol) AS symbols, count(DISTINCT client_name) AS clients,
 {isum("quantity")} AS quantity, {sql2("sum(value)")} AS value FROM deals GROUP BY 1"""),
)
def _(m):
    return m.deals.groupBy("deal_type").agg(
        F.count("*").alias("total_deals"), F.count_distinct("symbol").alias("symbols"), F.count_distinct("client_name").alias("clients"),
        F.sum("quantity").alias("quantity"), r2(F.sum("value")).alias("value"),
    )


@query(
    "agg07_daily_deal_stats",
    with_sql("deals", body=f"""SELECT deal_date, deal_type, count(*) AS deals, count(DISTINCT symbol) AS symbols, count(DISTINCT client_name) AS clients,
 CAST({sql_if("BUY", "quantity")} AS BIGINT) AS buy_quantity, CAST({sql_if("SELL", "quantity")} AS BIGINT) AS sell_quantity,
 {sql2(sql_if("BUY", "value"))} AS buy_value, {sql2(sql_if("SELL", "value"))} AS sell_value, {sql4("avg(avg_price)")} AS avg_price,
 {sql4("avg(quantity)")} AS avg_quantity FROM deals GROUP BY 1, 2"""),
)
def _(m):
    return m.deals.groupBy("deal_date", "deal_type").agg(
        F.count("*").alias("deals"), F.count_distinct("symbol").alias("symbols"), F.count_distinct("client_name").alias("clients"),
        buy("quantity").alias("buy_quantity"), sell("quantity").alias("sell_quantity"), r2(buy("value")).alias("buy_value"),
        r2(sell("value")).alias("sell_value"), r4(F.avg("avg_price")).alias("avg_price"), r4(F.avg("quantity")).alias("avg_quantity"),
    )


@query(
    "agg07_client_activity",
    with_sql("deals", body=f"""SELECT client_name, count(*) AS deals, count(DISTINCT symbol) AS symbols, {isum("quantity")} AS quantity, {sql2("sum(value)")} AS value,
 {sql4("avg(avg_price)")} AS avg_price, {icount_if("deal_type = 'BULK'")} AS bulk_deals, {icount_if("deal_type = 'BLOCK'")} AS block_deals FROM deals GROUP BY 1"""),
)
def _(m):
    return m.deals.groupBy("client_name").agg(
        F.count("*").alias("deals"), F.count_distinct("symbol").alias("symbols"), F.sum("quantity").alias("quantity"), r2(F.sum("value")).alias("value"),
        r4(F.avg("avg_price")).alias("avg_price"), F.count_if(F.col("deal_type") == "BULK").alias("bulk_deals"),
        F.count_if(F.col("deal_type") == "BLOCK").alias("block_deals"),
    )


@query(
    "agg07_symbol_activity",
    with_sql("deals", body=f"""SELECT symbol, count(*) AS deals, count(DISTINCT client_name) AS clients, {isum("quantity")} AS quantity,
 CAST({sql_if("BUY", "quantity")} AS BIGINT) AS buy_quantity, CAST({sql_if("SELL", "quantity")} AS BIGINT) AS sell_quantity
 FROM deals GROUP BY 1 ORDER BY quantity DESC, symbol LIMIT 20"""),
)
def _(m):
    # a client seldom deals twice in a symbol: nothing to combine before the shuffle, and a task's groups go by its rows
    deals = dealt(m.deals, "symbol", "client_name", rows=m.lines)
    per = deals.groupBy("symbol").agg(
        F.count("*").alias("deals"), F.count_distinct("client_name").alias("clients"), F.sum("quantity").alias("quantity"),
        buy("quantity").alias("buy_quantity"), sell("quantity").alias("sell_quantity"),
    )
    return per.orderBy(F.desc("quantity"), "symbol").limit(20)


@query(
    "agg07_two_sided_clients",
    with_sql("deals", body=f"""SELECT client_name, symbol, {icount_if("transaction_type = 'BUY'")} AS buy_count, {icount_if("transaction_type = 'SELL'")} AS sell_count,
 {sql4("avg(CASE WHEN transaction_type = 'BUY' THEN avg_price END)")} AS avg_buy_price,
 {sql4("avg(CASE WHEN transaction_type = 'SELL' THEN avg_price END)")} AS avg_sell_price FROM deals GROUP BY 1, 2 HAVING buy_count > 0 AND sell_count > 0"""),
)
def _(m):
    is_buy, is_sell = F.col("transaction_type") == "BUY", F.col("transaction_type") == "SELL"
    return m.deals.groupBy("client_name", "symbol").agg(
        F.count_if(is_buy).alias("buy_count"), F.count_if(is_sell).alias("sell_count"),
        r4(F.avg(F.when(is_buy, F.col("avg_price")))).alias("avg_buy_price"), r4(F.avg(F.when(is_sell, F.col("avg_price")))).alias("avg_sell_price"),
    ).filter("buy_count > 0 AND sell_count > 0")


@query(
    "agg07_weekly_deals",
    with_sql("deals", body=f"""SELECT CAST(date_trunc('week', deal_date) AS DATE) AS week_start, deal_type, count(*) AS deals, count(DISTINCT symbol) AS symbols,
 {isum("quantity")} AS quantity, {sql2("sum(value)")} AS value FROM deals GROUP BY 1, 2"""),
)
def _(m):
    return m.deals.groupBy(week_from_monday(F.col("deal_date")).alias("week_start"), "deal_type").agg(
        F.count("*").alias("deals"), F.count_distinct("symbol").alias("symbols"), F.sum("quantity").alias("quantity"), r2(F.sum("value")).alias("value")
    )


@query(
    "agg07_monthly_report",
    with_sql("deals", body=f"""SELECT CAST(date_trunc('month', deal_date) AS DATE) AS month_start, deal_type, transaction_type, count(*) AS deals,
 {sql4("min(avg_price)")} AS min_price, {sql4("max(avg_price)")} AS max_price, {sql4("avg(avg_price)")} AS avg_price, min(quantity) AS min_quantity,
 max(quantity) AS max_quantity, {sql4("avg(quantity)")} AS avg_quantity FROM deals GROUP BY 1, 2, 3"""),
)
def _(m):
    return m.deals.groupBy(F.trunc("deal_date", "MM").alias("month_start"), "deal_type", "transaction_type").agg(
        F.count("*").alias("deals"), r4(F.min("avg_price")).alias("min_price"), r4(F.max("avg_price")).alias("max_price"),
        r4(F.avg("avg_price")).alias("avg_price"), F.min("quantity").alias("min_quantity"), F.max("quantity").alias("max_quantity"),
        r4(F.avg("quantity")).alias("avg_quantity"),
    )


@query(
    "agg08_deal_analytics",
    with_sql("deals", body=f"""SELECT year(deal_date) * 100 + month(deal_date) AS ym, count(*) AS n, {sql2("sum(value)")} AS total, {sql4("avg(value)")} AS mean,
 {sql4("median(value)")} AS median, {sql4("stddev_samp(value)")} AS std, {icount_if("client_name IS NULL")} AS missing_client FROM deals GROUP BY 1"""),
)
def _(m):
    month = (F.year("deal_date") * 100 + F.month("deal_date")).cast("bigint")
    rows = m.deals.withColumn("ym", month)
    moments = rows.groupBy("ym").agg(
        F.count("*").alias("n"), r2(F.sum("value")).alias("total"), r4(F.avg("value")).alias("mean"), r4(F.stddev_samp("value")).alias("std"),
        F.count_if(F.col("client_name").isNull()).alias("missing_client"),
    )
    middle = stats.exact_median(rows, ["ym"], "value")
    return moments.join(middle, "ym", "left").withColumn("median", r4("median"))


def deal_shares_sql(by: str) -> str:
    return with_sql("deals", body=f"""SELECT {by}, count(*) AS n, {isum("quantity")} AS quantity, {sql2("sum(value)")} AS total, {sql4("avg(value)")} AS mean, {sql4("min(value)")} AS smallest, {sql4("max(value)")} AS largest,
 {sql4("median(value)")} AS median, {sql4("sum(value) * 100.0 / sum(sum(value)) OVER ()")} AS share_pct FROM deals GROUP BY 1""")


def deal_shares(m, by):
    """Deals per symbol or client: sizes, exact median and the share of all value."""
    per = m.deals.groupBy(by).agg(
        F.count("*").alias("n"), F.sum("quantity").alias("quantity"), F.sum("value").alias("_sum"), r4(F.avg("value")).alias("mean"),
        r4(F.min("value")).alias("smallest"), r4(F.max("value")).alias("largest"),
    )
    middle = stats.exact_median(m.deals, [by], "value").withColumnRenamed(by, "_by")
    rows = per.join(middle, F.col(by).eqNullSafe(F.col("_by")), "left")
    return stats.with_share(rows, "_sum", "share_pct").select(by, "n", "quantity", r2("_sum").alias("total"), "mean", "smallest", "largest", r4("median").alias("median"), r4("share_pct").alias("share_pct"))


@query("agg08_deals_by_symbol", deal_shares_sql("symbol"))
def _(m):
    return deal_shares(m, "symbol")


@query("agg08_deals_by_client", deal_shares_sql("client_name"))
def _(m):
    return deal_shares(m, "client_name")


@query(
    "agg09_backfill_tallies",
    with_sql("deals", body=f"""SELECT coalesce(CAST(year(deal_date) AS VARCHAR), 'TOTAL') AS yr, {icount_if("deal_type = 'BULK'")} AS bulk, {icount_if("deal_type = 'BLOCK'")} AS block,
 count(*) AS total FROM deals GROUP BY ROLLUP (year(deal_date))"""),
)
def _(m):
    return m.deals.rollup(F.year("deal_date").alias("y")).agg(
        F.count_if(F.col("deal_type") == "BULK").alias("bulk"), F.count_if(F.col("deal_type") == "BLOCK").alias("block"), F.count("*").alias("total")
    ).select(F.coalesce(F.col("y").cast("string"), F.lit("TOTAL")).alias("yr"), "bulk", "block", "total")


@query(
    "agg10_daily_summary",
    with_sql("trades", body=f"""SELECT trade_date, CASE WHEN suppkey % 3 = 0 THEN 'FO' ELSE 'CM' END AS segment, count(*) AS n, {isum("qty")} AS volume, {sql2("sum(amount)")} AS turnover,
 {sql4("avg(px)")} AS avg_price, {sql4("max(px)")} AS max_price, {sql4("min(px)")} AS min_price FROM trades GROUP BY 1, 2"""),
)
def _(m):
    """Kept as mergeable partials (sum, count, max, min) and finished at read, so parts add up."""
    part = (
        m.trades.withColumn("segment", F.when(F.col("suppkey") % 3 == 0, "FO").otherwise("CM"))
        .groupBy("trade_date", "segment", F.pmod(F.xxhash64("symbol"), F.lit(4)).alias("part"))
        .agg(F.count("*").alias("n"), F.sum("qty").alias("q"), F.sum("amount").alias("a"), F.sum("px").alias("s"), F.max("px").alias("hi"), F.min("px").alias("lo"))
    )
    return part.groupBy("trade_date", "segment").agg(
        F.sum("n").alias("n"), F.sum("q").cast("bigint").alias("volume"), r2(F.sum("a")).alias("turnover"),
        r4(F.sum("s") / F.sum("n")).alias("avg_price"), r4(F.max("hi")).alias("max_price"), r4(F.min("lo")).alias("min_price"),
    )


@query(
    "agg11_quarter_coverage",
    with_sql("financials", body=f"""SELECT year, quarter, count(*) AS records, count(DISTINCT symbol) AS symbols, count(current_liabilities) AS has_liabilities, {sql4("avg(eps)")} AS avg_eps
 FROM financials GROUP BY 1, 2"""),
)
def _(m):
    return m.financials.groupBy("year", "quarter").agg(
        F.count("*").alias("records"), F.count_distinct("symbol").alias("symbols"), F.count("current_liabilities").alias("has_liabilities"), r4(F.avg("eps")).alias("avg_eps")
    )


@query(
    "agg12_multi_instrument_tickers",
    with_sql("constituents", body="""SELECT symbol, count(DISTINCT partkey) AS instruments, string_agg(DISTINCT sector, ',' ORDER BY sector) AS sectors FROM constituents
 GROUP BY 1 HAVING instruments > 1"""),
)
def _(m):
    return m.constituents.groupBy("symbol").agg(
        F.count_distinct("partkey").alias("instruments"), F.array_join(F.array_sort(F.collect_set("sector")), ",").alias("sectors")
    ).filter("instruments > 1")


@query(
    "agg13_duplicate_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING copies > 1",
)
def _(m):
    return duplicate_keys(m.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "agg13_isin_on_both_sources",
    with_sql("listings", body="""SELECT isin, count(*) AS copies, string_agg(DISTINCT source, ',' ORDER BY source) AS sources FROM listings WHERE isin IS NOT NULL GROUP BY 1 HAVING copies > 1"""),
)
def _(m):
    return m.listings.filter("isin IS NOT NULL").groupBy("isin").agg(
        F.count("*").alias("copies"), F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources")
    ).filter("copies > 1")


@query(
    "agg14_latest_version",
    """SELECT o_custkey, arg_max(o_orderkey, row(o_orderdate, o_orderkey)) AS o_orderkey, arg_max(o_orderstatus, row(o_orderdate, o_orderkey)) AS o_orderstatus FROM orders GROUP BY 1""",
)
def _(m):
    rows = m.table("orders").select("o_custkey", "o_orderkey", "o_orderstatus", F.struct("o_orderdate", "o_orderkey").alias("v"))
    return topk.latest(rows, ["o_custkey"], "v").drop("v")


@query(
    "agg15_membership_as_of",
    with_sql("constituents", body="""SELECT index_name, symbol, partkey, action, effective_date FROM (SELECT *, row_number() OVER (PARTITION BY index_name, symbol, partkey
 ORDER BY effective_date DESC) AS rk FROM constituents WHERE effective_date <= DATE '2024-05-15') WHERE rk = 1 AND action <> 'REMOVE'"""),
)
def _(m):
    out = membership(m.constituents, ["index_name", "symbol", "partkey"], F.lit("2024-05-15").cast("date"), ["action"])
    return out.select("index_name", "symbol", "partkey", "action", "effective_date")


@query(
    "agg16_latest_value",
    with_sql("macro", body="SELECT indicator_code, arg_max(value, indicator_date) AS latest_value, max(indicator_date) AS latest_date FROM macro GROUP BY 1"),
)
def _(m):
    return m.macro.groupBy("indicator_code").agg(F.max_by("value", "indicator_date").alias("latest_value"), F.max("indicator_date").alias("latest_date"))


@query(
    "agg17_monthly_average",
    f"""SELECT o_orderpriority AS indicator_code, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, {sql4("avg(o_totalprice)")} AS avg_value, count(*) AS observations FROM orders GROUP BY 1, 2""",
)
def _(m):
    return m.table("orders").groupBy(F.col("o_orderpriority").alias("indicator_code"), F.trunc("o_orderdate", "MM").alias("month_start")).agg(
        r4(F.avg("o_totalprice")).alias("avg_value"), F.count("*").alias("observations")
    )


@query(
    "agg18_cross_section_volatility",
    with_sql("ohlc", body=f"SELECT trade_date, {sql4('stddev_pop(close)')} AS volatility, count(DISTINCT symbol) AS active_symbols FROM ohlc GROUP BY 1"),
)
def _(m):
    return m.closes.groupBy("trade_date").agg(r4(F.stddev_pop("close")).alias("volatility"), F.count("symbol").alias("active_symbols"))


@query(
    "agg19_sector_composition",
    with_sql("constituents", body=f"""SELECT index_name, sector, count(*) AS constituents, {sql4("sum(weight)")} AS total_weight, {sql4("avg(weight)")} AS avg_weight FROM constituents
 WHERE action = 'ADD' AND sector IS NOT NULL GROUP BY 1, 2"""),
)
def _(m):
    return m.constituents.filter("action = 'ADD' AND sector IS NOT NULL").groupBy("index_name", "sector").agg(
        F.count("*").alias("constituents"), r4(F.sum("weight")).alias("total_weight"), r4(F.avg("weight")).alias("avg_weight")
    )


@query(
    "agg19_index_totals",
    with_sql("constituents", body=f"""SELECT index_name, count(*) AS total, count(DISTINCT symbol) AS symbols, {sql4("sum(weight)")} AS total_weight, min(effective_date) AS min_date,
 max(effective_date) AS max_date FROM constituents GROUP BY 1"""),
)
def _(m):
    return m.constituents.groupBy("index_name").agg(
        F.count("*").alias("total"), F.count_distinct("symbol").alias("symbols"), r4(F.sum("weight")).alias("total_weight"),
        F.min("effective_date").alias("min_date"), F.max("effective_date").alias("max_date"),
    )


@query(
    "agg20_source_coverage",
    with_sql("listings", body=f"""SELECT source, count(*) AS total_records, count(DISTINCT symbol) AS symbols, count(DISTINCT isin) AS isins, {icount_if("isin IS NULL")} AS null_isins,
 {sql4("count_if(isin IS NULL) * 100.0 / count(*)")} AS null_pct, {sql4("min(close)")} AS min_close, {sql4("max(close)")} AS max_close, {icount_if("close <= 0")} AS invalid_prices FROM listings GROUP BY 1"""),
)
def _(m):
    return m.listings.groupBy("source").agg(
        F.count("*").alias("total_records"), F.count_distinct("symbol").alias("symbols"), F.count_distinct("isin").alias("isins"),
        F.count_if(F.col("isin").isNull()).alias("null_isins"), r4(F.count_if(F.col("isin").isNull()) * 100.0 / F.count("*")).alias("null_pct"),
        r4(F.min("close")).alias("min_close"), r4(F.max("close")).alias("max_close"), F.count_if(F.col("close") <= 0).alias("invalid_prices"),
    )


@query(
    "agg21_calendar_months",
    with_sql("calendar", body=f"""SELECT year(trade_date) AS y, month(trade_date) AS mth, {icount_if("is_trading_day")} AS trading_days, {icount_if("day_type = 'MARKET_HOLIDAY'")} AS holidays,
 {icount_if("day_type = 'WEEKEND'")} AS weekends FROM calendar GROUP BY 1, 2"""),
)
def _(m):
    return calendar_of(m).groupBy(F.year("trade_date").cast("bigint").alias("y"), F.month("trade_date").cast("bigint").alias("mth")).agg(
        F.count_if("is_trading_day").alias("trading_days"), F.count_if(F.col("day_type") == "MARKET_HOLIDAY").alias("holidays"),
        F.count_if(F.col("day_type") == "WEEKEND").alias("weekends"),
    )


@query(
    "agg22_weekly_feature_means",
    with_sql("ohlc", body=f"""SELECT symbol, isoyear(trade_date) AS iso_year, weekofyear(trade_date) AS iso_week, {sql4("avg(close)")} AS mean_close, count(*) AS days FROM ohlc GROUP BY 1, 2, 3"""),
)
def _(m):
    return m.closes.groupBy(
        "symbol", F.extract(F.lit("YEAROFWEEK"), "trade_date").cast("bigint").alias("iso_year"), F.weekofyear("trade_date").cast("bigint").alias("iso_week")
    ).agg(r4(F.avg("close")).alias("mean_close"), F.count("*").alias("days"))


@query(
    "agg23_factor_by_reduce",
    with_sql("ca", body=f"SELECT symbol, {sql4('list_reduce(list(adjustment_factor ORDER BY ex_date), lambda a, x: a * x)')} AS factor FROM ca WHERE action_type IN ('SPLIT', 'BONUS') GROUP BY 1"),
)
def _(m):
    return m.ca.filter(F.col("action_type").isin("SPLIT", "BONUS")).groupBy("symbol").agg(r4(F.product("adjustment_factor")).alias("factor"))


@query(
    "agg24_table_summary",
    with_sql("ohlc", body="SELECT count(*) AS total, count(DISTINCT symbol) AS symbols, min(trade_date) AS first_day, max(trade_date) AS last_day FROM ohlc"),
)
def _(m):
    bars = m.trades.select("symbol", "trade_date").distinct()
    per = bars.groupBy("symbol").agg(F.count("*").alias("n"), F.min("trade_date").alias("a"), F.max("trade_date").alias("b"))
    return per.agg(F.sum("n").alias("total"), F.count("*").alias("symbols"), F.min("a").alias("first_day"), F.max("b").alias("last_day"))


@query(
    "agg25_drift",
    with_sql("deals", body=f""", p AS (SELECT deal_type, CAST(year(deal_date) AS INTEGER) AS y, count(*) AS n, avg(value) AS mean, stddev(value) AS std FROM deals GROUP BY ALL)
 SELECT c.deal_type, c.y, c.n, {sql4("c.mean")} AS mean, {sql4("c.std")} AS std, {sql4("b.mean")} AS base_mean, {sql4("abs(c.mean - b.mean) / b.std")} AS shift,
 abs(c.mean - b.mean) / b.std > 0.01 AS drifted FROM p c JOIN p b ON c.deal_type = b.deal_type AND c.y = b.y + 1"""),
)
def _(m):
    """Every year against the year before."""
    now = stats.profile(m.deals.withColumn("y", F.year("deal_date")), ["deal_type", "y"], "value")
    before = now.withColumn("y", F.col("y") + 1)
    return stats.drift(now, before, ["deal_type", "y"], 0.01).select(
        "deal_type", "y", "n", r4("mean").alias("mean"), r4("std").alias("std"), r4("base_mean").alias("base_mean"), r4("shift").alias("shift"), "drifted"
    )


QUARTILES = (0.25, 0.5, 0.75)


@query(
    "agg25_quartiles",
    with_sql("deals", body=f"""SELECT deal_type, CAST(year(deal_date) AS INTEGER) AS y, count(*) AS n, {', '.join(f"{sql4(f'quantile_cont(value, {p})')} AS q{i + 1}" for i, p in enumerate(QUARTILES))}
 FROM (SELECT deal_type, deal_date, CASE WHEN deal_type = 'BLOCK' AND year(deal_date) = 1995 THEN NULL ELSE value END AS value FROM deals) GROUP BY 1, 2"""),
)
def _(m):
    """Exact quartiles per metric and period; one period has no values at all."""
    rows = m.deals.withColumn("y", F.year("deal_date"))
    rows = rows.withColumn("value", F.when(~((F.col("deal_type") == "BLOCK") & (F.col("y") == 1995)), F.col("value")))
    sizes = rows.groupBy("deal_type", "y").agg(F.count("*").alias("n"))
    found = stats.exact_quantiles(rows, ["deal_type", "y"], "value", list(QUARTILES))
    return sizes.join(found, ["deal_type", "y"]).select("deal_type", "y", "n", *[r4(F.col("quantiles")[i]).alias(f"q{i + 1}") for i in range(3)])


@query(
    "sort01_mixed_order",
    with_sql("constituents", body="SELECT index_name, symbol, partkey, weight FROM constituents WHERE action = 'ADD' ORDER BY weight DESC NULLS LAST, symbol, partkey LIMIT 50"),
)
def _(m):
    added = m.constituents.filter("action = 'ADD'").select("index_name", "symbol", "partkey", "weight")
    return added.orderBy(F.desc_nulls_last("weight"), "symbol", "partkey").limit(50)


@query(
    "sort01_by_expression",
    with_sql("financials", body="SELECT symbol, period_end_date, net_profit FROM financials ORDER BY abs(net_profit) DESC, symbol, period_end_date LIMIT 30"),
)
def _(m):
    return m.financials.select("symbol", "period_end_date", "net_profit").orderBy(F.abs("net_profit").desc(), "symbol", "period_end_date").limit(30)


@query("sort02_page", with_sql("ohlc", body=f"SELECT symbol, trade_date, {sql4('close')} AS close FROM ohlc ORDER BY trade_date DESC, symbol LIMIT 100 OFFSET 200"))
def _(m):
    return topk.page(m.closes, [F.desc("trade_date"), F.col("symbol")], 3, 100).withColumn("close", r4("close"))


@query("sort02_keyset_page", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey > 5000 ORDER BY o_orderkey LIMIT 100")
def _(m):
    return topk.page_after(m.table("orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 5000, 100)


@query("sort03_top_deals", with_sql("deals", body="SELECT deal_no, deal_line, symbol, client_name, quantity, value FROM deals ORDER BY value DESC, deal_no, deal_line LIMIT 50"))
def _(m):
    return m.deals.select("deal_no", "deal_line", "symbol", "client_name", "quantity", "value").orderBy(F.desc("value"), "deal_no", "deal_line").limit(50)


@query("sort04_latest_bar", with_sql("ohlc", body=f"SELECT symbol, max(trade_date) AS trade_date, {sql4('arg_max(close, trade_date)')} AS close FROM ohlc GROUP BY 1"))
def _(m):
    return topk.latest(m.closes, ["symbol"], "trade_date").select("symbol", "trade_date", r4("close").alias("close"))


@query(
    "set01_union_of_sources",
    "SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS on_date, o_totalprice AS value FROM orders UNION ALL SELECT 'SHIP', CAST(l_shipdate AS DATE), l_extendedprice FROM lineitem",
)
def _(m):
    a = m.table("orders").select(F.col("o_orderpriority").alias("series"), F.to_date("o_orderdate").alias("on_date"), F.col("o_totalprice").alias("value"))
    b = m.table("lineitem").select(F.lit("SHIP").alias("series"), F.to_date("l_shipdate").alias("on_date"), F.col("l_extendedprice").alias("value"))
    return a.unionByName(b)


CHECKS = [
    ("Missing symbols", "symbol = '' OR symbol IS NULL"), ("Missing client names", "client_name = '' OR client_name IS NULL"),
    ("Zero quantities", "quantity = 0"), ("Zero prices", "avg_price = 0"), ("Negative quantities", "quantity < 0"), ("Negative prices", "avg_price < 0"),
]


@query("set02_completeness_checks", with_sql("deals", body=" UNION ALL ".join(f"SELECT '{n}' AS check_type, count(*) AS n FROM deals WHERE {p}" for n, p in CHECKS)))
def _(m):
    """One pass counts every check; the single row is then unpivoted."""
    row = m.deals.agg(*[F.count_if(F.expr(p)).alias(n) for n, p in CHECKS])
    return row.unpivot([], [n for n, _ in CHECKS], "check_type", "n")


@query("set02_table_counts", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in ("lineitem", "orders", "customer")))
def _(m):
    parts = [m.table(t).agg(F.lit(t).alias("table_name"), F.count("*").alias("n")) for t in ("lineitem", "orders", "customer")]
    return reduce(DataFrame.unionByName, parts)


@query("set03_distinct", with_sql("constituents", body="SELECT DISTINCT index_name, sector FROM constituents"))
def _(m):
    return m.constituents.select("index_name", "sector").distinct()


@query("src21_first_nonempty_source", with_sql("macro", body="SELECT indicator_code, indicator_date, value FROM macro WHERE indicator_code = '5-LOW'"))
def _(m):
    feeds = [m.macro.filter(F.col("indicator_code") == code) for code in ("9-NONE", "5-LOW", "1-URGENT")]
    return first_nonempty(feeds)


@query("time06_date_buckets", with_sql("deals", body=f"""SELECT deal_date, deal_date - CAST(dayofweek(deal_date) AS INTEGER) AS sunday_week, CAST(date_trunc('week', deal_date) AS DATE) AS monday_week,
 CAST(date_trunc('month', deal_date) AS DATE) AS month_start, quarter(deal_date) AS q, year(deal_date) AS y, count(*) AS n FROM deals GROUP BY 1"""))
def _(m):
    d = F.col("deal_date")
    return m.deals.groupBy("deal_date").agg(F.count("*").alias("n")).select(
        "deal_date", week_from_sunday(d).alias("sunday_week"), week_from_monday(d).alias("monday_week"), F.trunc(d, "MM").alias("month_start"),
        F.quarter(d).cast("bigint").alias("q"), F.year(d).cast("bigint").alias("y"), "n",
    )


@query(
    "flagship_adjusted_features",
    with_sql("ohlc", "ca", body=f""", f AS (SELECT symbol, ex_date, product(adjustment_factor) OVER (PARTITION BY symbol ORDER BY ex_date DESC, action_type ROWS UNBOUNDED PRECEDING) AS cum FROM ca),
 adj AS (SELECT o.symbol, o.trade_date, close / coalesce(cum, 1) AS close, coalesce(cum, 1) AS factor FROM ohlc o ASOF LEFT JOIN f ON o.symbol = f.symbol AND o.trade_date < f.ex_date),
 s AS (SELECT *, CASE WHEN count(*) OVER w5 = 5 THEN avg(close) OVER w5 END AS sma_5, CASE WHEN count(*) OVER w20 = 20 THEN avg(close) OVER w20 END AS sma_20,
   list_reduce(list(close) OVER (PARTITION BY symbol ORDER BY trade_date ROWS 499 PRECEDING), lambda e, x: e * CAST({1 - 2 / 13!r} AS DOUBLE) + x * CAST({2 / 13!r} AS DOUBLE)) AS ema_12
   FROM adj WINDOW w5 AS (PARTITION BY symbol ORDER BY trade_date ROWS 4 PRECEDING), w20 AS (PARTITION BY symbol ORDER BY trade_date ROWS 19 PRECEDING))
 SELECT symbol, max(trade_date) AS trade_date, {sql4("arg_max(close, trade_date)")} AS close, {sql4("arg_max(factor, trade_date)")} AS adjustment_factor,
 {sql4("arg_max(sma_5, trade_date)")} AS sma_5, {sql4("arg_max(sma_20, trade_date)")} AS sma_20, {sql4("arg_max(ema_12, trade_date)")} AS ema_12 FROM s GROUP BY 1"""),
)
def _(m):
    from ticklake.operators.adjust import adjust_prices
    from ticklake.operators.indicators import emas, sma

    adjusted = adjust_prices(m.closes, cumulative_factors(m.ca))
    feats = emas(sma(adjusted), spans=(12,))
    cols = ("close", "adjustment_factor", "sma_5", "sma_20", "ema_12")
    return topk.latest(feats, ["symbol"], "trade_date").select("symbol", "trade_date", *[r4(c).alias(c) for c in cols])


@query(
    "prj15_signals",
    with_sql("ohlc", body="""SELECT symbol, trade_date, CASE WHEN s5 > s20 AND s20 > s50 THEN 'Bullish' WHEN s5 < s20 AND s20 < s50 THEN 'Bearish' ELSE 'Neutral' END AS trend,
 CASE WHEN w < 20 THEN 'Consolidating' WHEN w > 40 THEN 'Volatile' ELSE 'Normal' END AS regime,
 CASE WHEN l = 0 THEN 'Overbought' WHEN 100 - 100 / (1 + g / l) > 70 THEN 'Overbought' WHEN 100 - 100 / (1 + g / l) < 30 THEN 'Oversold' ELSE 'Neutral' END AS rsi_state FROM
 (SELECT symbol, trade_date, CASE WHEN count(*) OVER w5 = 5 THEN avg(close) OVER w5 END AS s5, CASE WHEN count(*) OVER w20 = 20 THEN avg(close) OVER w20 END AS s20,
  CASE WHEN count(*) OVER w50 = 50 THEN avg(close) OVER w50 END AS s50, CASE WHEN count(*) OVER w20 = 20 THEN 4 * stddev_pop(close) OVER w20 / avg(close) OVER w20 * 100 END AS w,
  avg(greatest(coalesce(d, 0), 0)) OVER w14 AS g, avg(greatest(coalesce(-d, 0), 0)) OVER w14 AS l
  FROM (SELECT *, close - lag(close) OVER (PARTITION BY symbol ORDER BY trade_date) AS d FROM ohlc)
  WINDOW w5 AS (PARTITION BY symbol ORDER BY trade_date ROWS 4 PRECEDING), w14 AS (PARTITION BY symbol ORDER BY trade_date ROWS 13 PRECEDING),
   w20 AS (PARTITION BY symbol ORDER BY trade_date ROWS 19 PRECEDING), w50 AS (PARTITION BY symbol ORDER BY trade_date ROWS 49 PRECEDING))"""),
)
def _(m):
    from ticklake.operators import indicators as ind

    out = rsi_simple(ind.bollinger(ind.sma(m.closes, windows=(5, 20, 50))))
    return out.select(
        "symbol", "trade_date", ind.trend_signal(F.col("sma_5"), F.col("sma_20"), F.col("sma_50")).alias("trend"),
        ind.band_regime(F.col("bb_width")).alias("regime"), ind.rsi_signal(F.col("rsi_14")).alias("rsi_state"),
    )
