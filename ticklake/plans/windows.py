"""WIN: window operators."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ticklake.bridge import with_sql
from ticklake.functions.rounding import r2, r4, sql2, sql4
from ticklake.operators import indicators as ind
from ticklake.operators.asof import time_bucket
from ticklake.operators.series import daily, ema_long, lag_long, rolling_long
from ticklake.plans.registry import query

STAMP_MS = 1_704_067_200_000


def ema_fold_sql(column: str, span: int, source: str, by: str = "symbol", order: str = "trade_date", look: int = 500) -> str:
    """The recursion as a fold over the last rows; (1 - alpha)^look is below one part in 10^16."""
    a = 2.0 / (span + 1)
    return (
        f"list_reduce(list({column}) OVER (PARTITION BY {by} ORDER BY {order} ROWS BETWEEN {look - 1} PRECEDING AND "
        f"CURRENT ROW), lambda e, x: e * CAST({1 - a!r} AS DOUBLE) + x * CAST({a!r} AS DOUBLE))"
    )


W = "OVER (PARTITION BY symbol ORDER BY trade_date"


@query(
    "win01_sma_full",
    with_sql("ohlc", body=f"""SELECT symbol, trade_date,
 CASE WHEN count(close) {W} ROWS 4 PRECEDING) = 5 THEN {sql4(f"avg(close) {W} ROWS 4 PRECEDING)")} END AS sma_5,
 CASE WHEN count(close) {W} ROWS 19 PRECEDING) = 20 THEN {sql4(f"avg(close) {W} ROWS 19 PRECEDING)")} END AS sma_20
 FROM ohlc"""),
)
def _(m):
    return ind.sma(m.closes).select("symbol", "trade_date", r4("sma_5").alias("sma_5"), r4("sma_20").alias("sma_20"))


@query(
    "win02_sma_partial",
    with_sql("ohlc", body=f"SELECT symbol, trade_date, {sql4(f'avg(close) {W} ROWS 19 PRECEDING)')} AS sma_20 FROM ohlc"),
)
def _(m):
    return ind.sma(m.closes, windows=(20,), partial=True).select("symbol", "trade_date", r4("sma_20").alias("sma_20"))


@query(
    "win03_ema",
    with_sql("ohlc", body=f"""SELECT symbol, trade_date, {sql4(ema_fold_sql("close", 12, "ohlc"))} AS ema_12,
 {sql4(ema_fold_sql("close", 26, "ohlc"))} AS ema_26 FROM ohlc"""),
)
def _(m):
    return ind.emas(m.closes).select("symbol", "trade_date", r4("ema_12").alias("ema_12"), r4("ema_26").alias("ema_26"))


@query(
    "win04_ema_in_range",
    with_sql("ohlc", body=f"""SELECT symbol, trade_date, {sql4(ema_fold_sql("close", 20, "ohlc"))} AS ema_20
 FROM ohlc WHERE trade_date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'"""),
)
def _(m):
    bars = m.sliced("1997-01-01", "1998-12-31").closes
    return ind.emas(bars, spans=(20,)).select("symbol", "trade_date", r4("ema_20").alias("ema_20"))


GAPS = f""", g AS (SELECT symbol, trade_date, CASE WHEN (dayofyear(trade_date) + suppkey) % 7 <> 0 THEN close END AS close FROM ohlc),
 v AS (SELECT symbol, trade_date, close, count(close) {W}) AS k FROM g), f AS (SELECT symbol, k, trade_date, close FROM v WHERE close IS NOT NULL),
 e AS (SELECT symbol, k, {ema_fold_sql("close", 12, "f", look=260)} AS e FROM f)"""


@query("win03_ema_with_gaps", with_sql("ohlc", body=f"{GAPS} SELECT v.symbol, v.trade_date, {sql4('e')} AS ema_12 FROM v LEFT JOIN e ON v.symbol = e.symbol AND v.k = e.k"))
def _(m):
    """Closes with planted nulls: a day without a close shows the mean so far."""
    bars = m.ohlc.withColumn("close", F.when((F.dayofyear("trade_date") + F.col("suppkey")) % 7 != 0, F.col("close")))
    return ind.emas(bars, spans=(12,)).select("symbol", "trade_date", r4("ema_12").alias("ema_12"))


GL = f""", gl AS (SELECT symbol, trade_date, close, greatest(coalesce(d, 0), 0) AS gain, greatest(coalesce(-d, 0), 0) AS loss
 FROM (SELECT *, close - lag(close) {W}) AS d FROM ohlc))"""
RSI_EMA = f""", g AS (SELECT symbol, trade_date, close, {ema_fold_sql("gain", 14, "gl")} AS g,
 {ema_fold_sql("loss", 14, "gl")} AS l FROM gl)"""


@query(
    "win05_rsi_smoothed",
    with_sql("ohlc", body=f"""{GL}{RSI_EMA} SELECT symbol, trade_date,
 CASE WHEN l > 0 THEN {sql4("100 - 100 / (1 + g / l)")} END AS rsi_14 FROM g"""),
)
def _(m):
    return ind.rsi_smoothed(m.closes).select("symbol", "trade_date", r4("rsi_14").alias("rsi_14"))


@query(
    "win06_rsi_simple",
    with_sql("ohlc", body=f"""{GL}, s AS (SELECT symbol, trade_date, avg(gain) {W} ROWS 13 PRECEDING) AS g,
 avg(loss) {W} ROWS 13 PRECEDING) AS l FROM gl)
 SELECT symbol, trade_date, CASE WHEN l = 0 THEN 100.000000 ELSE {sql4("100 - 100 / (1 + g / l)")} END AS rsi_14 FROM s"""),
)
def _(m):
    return ind.rsi_simple(m.closes).select("symbol", "trade_date", r4("rsi_14").alias("rsi_14"))


@query(
    "win07_feature_table",
    with_sql("ohlc", body=f"""{GL}{RSI_EMA} SELECT o.symbol, o.trade_date, {sql4("o.close")} AS close, o.sma_5, o.sma_20,
 o.ema_12, o.ema_26, CASE WHEN l > 0 THEN {sql4("100 - 100 / (1 + g / l)")} END AS rsi_14,
 'v1' AS feature_version, {STAMP_MS} AS feature_timestamp
 FROM (SELECT symbol, trade_date, close,
   CASE WHEN count(close) {W} ROWS 4 PRECEDING) = 5 THEN {sql4(f"avg(close) {W} ROWS 4 PRECEDING)")} END AS sma_5,
   CASE WHEN count(close) {W} ROWS 19 PRECEDING) = 20 THEN {sql4(f"avg(close) {W} ROWS 19 PRECEDING)")} END AS sma_20,
   {sql4(ema_fold_sql("close", 12, "ohlc"))} AS ema_12, {sql4(ema_fold_sql("close", 26, "ohlc"))} AS ema_26 FROM ohlc) o
 JOIN g USING (symbol, trade_date)"""),
)
def _(m):
    out = ind.features(m.closes, "v1", STAMP_MS)
    return out.withColumns({c: r4(c) for c in ("close", "sma_5", "sma_20", "ema_12", "ema_26", "rsi_14")})


SMAS = (10, 50, 100, 200)


@query(
    "win08_wide_features",
    with_sql("ohlc", body=f"""SELECT symbol, trade_date, {", ".join(f"CASE WHEN count(close) {W} ROWS {n - 1} PRECEDING) = {n} THEN {sql4(f'avg(close) {W} ROWS {n - 1} PRECEDING)')} END AS sma_{n}" for n in SMAS)},
 {sql4(ema_fold_sql("close", 50, "ohlc", look=1000))} AS ema_50, {sql4(ema_fold_sql("close", 12, "ohlc") + " - " + ema_fold_sql("close", 26, "ohlc"))} AS macd, 'v2' AS feature_version FROM ohlc"""),
)
def _(m):
    out = ind.features_wide(m.ohlc.drop("suppkey", "open", "turnover", "trades"), "v2", STAMP_MS)
    return out.select("symbol", "trade_date", *[r4(f"sma_{n}").alias(f"sma_{n}") for n in SMAS], r4("ema_50").alias("ema_50"), r4("macd").alias("macd"), "feature_version")


@query(
    "win08_macd",
    with_sql("ohlc", body=f""", m AS (SELECT symbol, trade_date, {ema_fold_sql("close", 12, "ohlc")} -
 {ema_fold_sql("close", 26, "ohlc")} AS macd FROM ohlc),
 s AS (SELECT *, {ema_fold_sql("macd", 9, "m", look=250)} AS sig FROM m)
 SELECT symbol, trade_date, {sql4("macd")} AS macd, {sql4("sig")} AS macd_signal, {sql4("macd - sig")} AS macd_histogram FROM s"""),
)
def _(m):
    return ind.macd(m.closes).select(
        "symbol", "trade_date", r4("macd").alias("macd"), r4("macd_signal").alias("macd_signal"),
        r4("macd_histogram").alias("macd_histogram"),
    )


@query(
    "win08_bollinger",
    with_sql("ohlc", body=f""", b AS (SELECT symbol, trade_date, count(close) {W} ROWS 19 PRECEDING) AS n,
 avg(close) {W} ROWS 19 PRECEDING) AS mid, stddev_pop(close) {W} ROWS 19 PRECEDING) AS dev FROM ohlc)
 SELECT symbol, trade_date, CASE WHEN n = 20 THEN {sql4("mid")} END AS bb_middle,
 CASE WHEN n = 20 THEN {sql4("mid + 2 * dev")} END AS bb_upper, CASE WHEN n = 20 THEN {sql4("mid - 2 * dev")} END AS bb_lower,
 CASE WHEN n = 20 THEN {sql4("4 * dev / mid * 100")} END AS bb_width FROM b"""),
)
def _(m):
    cols = ("bb_middle", "bb_upper", "bb_lower", "bb_width")
    return ind.bollinger(m.closes).select("symbol", "trade_date", *[r4(c).alias(c) for c in cols])


@query(
    "win08_stochastic_atr_vwap_obv",
    with_sql("ohlc", body=f""", a AS (SELECT *, min(low) {W} ROWS 13 PRECEDING) AS lo, max(high) {W} ROWS 13 PRECEDING) AS hi,
 lag(close) {W}) AS pc FROM ohlc),
 b AS (SELECT *, CASE WHEN hi > lo THEN (close - lo) / (hi - lo) * 100 END AS k,
   greatest(high - low, abs(high - pc), abs(low - pc)) AS tr,
   CASE WHEN close > pc THEN volume WHEN close < pc THEN -volume ELSE 0 END AS sv FROM a)
 SELECT symbol, trade_date, {sql4("k")} AS stochastic_k, {sql4(f"avg(k) {W} ROWS 2 PRECEDING)")} AS stochastic_d,
 CASE WHEN count(tr) {W} ROWS 13 PRECEDING) = 14 THEN {sql4(f"avg(tr) {W} ROWS 13 PRECEDING)")} END AS atr_14,
 {sql4(f"sum((high + low + close) / 3 * volume) {W} ROWS 19 PRECEDING) / sum(volume) {W} ROWS 19 PRECEDING)")} AS vwap,
 CAST(sum(sv) {W} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS obv FROM b"""),
)
def _(m):
    out = ind.obv(ind.vwap(ind.atr(ind.stochastic(m.ohlc))))
    return out.select(
        "symbol", "trade_date", r4("stochastic_k").alias("stochastic_k"), r4("stochastic_d").alias("stochastic_d"),
        r4("atr_14").alias("atr_14"), r4("vwap").alias("vwap"), "obv",
    )


@query(
    "win09_volume_ma_20",
    with_sql("ohlc", body=f"SELECT symbol, trade_date, {sql4(f'avg(volume) {W} ROWS 19 PRECEDING)')} AS volume_ma_20 FROM ohlc"),
)
def _(m):
    w = daily().rowsBetween(-19, 0)
    return m.ohlc.select("symbol", "trade_date", r4(F.avg("volume").over(w)).alias("volume_ma_20"))


@query(
    "win10_cumulative_factors",
    with_sql("ca", body=f"""SELECT symbol, ex_date, action_type, adjustment_factor,
 {sql4("product(adjustment_factor) OVER (PARTITION BY symbol ORDER BY ex_date DESC, action_type ROWS UNBOUNDED PRECEDING)")}
 AS cumulative_factor FROM ca"""),
)
def _(m):
    from ticklake.operators.adjust import cumulative_factors

    return cumulative_factors(m.ca).select(
        "symbol", "ex_date", "action_type", "adjustment_factor", r4("cumulative_factor").alias("cumulative_factor")
    )


@query(
    "win11_macro_changes",
    with_sql("macro", body=f"""SELECT indicator_code, indicator_date, value, {sql2("value - pv")} AS change,
 {sql4("(value - pv) / pv * 100")} AS change_pct FROM (SELECT *, lag(value) OVER (PARTITION BY indicator_code ORDER BY
 indicator_date) AS pv FROM macro) WHERE value - pv <> 0"""),
)
def _(m):
    w = Window.partitionBy("indicator_code").orderBy("indicator_date")
    pv = F.lag("value").over(w)
    return (
        m.macro.withColumn("pv", pv)
        .filter(F.col("value") - F.col("pv") != 0)
        .select(
            "indicator_code", "indicator_date", "value", r2(F.col("value") - F.col("pv")).alias("change"),
            r4(F.try_divide(F.col("value") - F.col("pv"), F.col("pv")) * 100).alias("change_pct"),
        )
    )


@query(
    "win12_rolling_correlation",
    with_sql("macro", "ohlc", body=f""", mkt AS (SELECT CAST(date_trunc('month', trade_date) AS DATE) AS mth,
 sum(turnover) AS turnover FROM ohlc GROUP BY 1),
 c AS (SELECT indicator_code, indicator_date, count(*) OVER w AS n, corr(value, turnover) OVER w AS c FROM macro JOIN mkt ON indicator_date = mth
 WINDOW w AS (PARTITION BY indicator_code ORDER BY indicator_date ROWS BETWEEN 12 PRECEDING AND CURRENT ROW))
 SELECT indicator_code, indicator_date, CASE WHEN n > 1 AND NOT isnan(c) THEN round(c + 1e-9, 3) END AS rolling_correlation FROM c"""),
)
def _(m):
    mkt = m.trades.groupBy(F.trunc("trade_date", "MM").alias("indicator_date")).agg(F.sum("amount").alias("turnover"))
    w = Window.partitionBy("indicator_code").orderBy("indicator_date").rowsBetween(-12, 0)
    return m.macro.join(mkt, "indicator_date").select(
        "indicator_code", "indicator_date",
        F.round(F.corr("value", "turnover").over(w) + F.lit(1e-9), 3).alias("rolling_correlation"),
    )


@query(
    "win13_volume_leaders_per_day",
    with_sql("ohlc", body=f"""SELECT trade_date, symbol, volume, turnover, {sql4("close")} AS close, {sql4("(close - pc) / pc * 100")} AS pct_change
 FROM (SELECT *, row_number() OVER (PARTITION BY trade_date ORDER BY volume DESC, symbol) AS rk FROM
 (SELECT *, lag(close) {W}) AS pc FROM ohlc)) WHERE rk <= 10"""),
)
def _(m):
    from ticklake.operators.topk import top_k

    bars = m.ohlc.withColumn("pc", F.lag("close").over(daily()))
    best = top_k(bars, ["trade_date"], [F.col("volume").desc(), F.col("symbol").asc()], 10)
    return best.select(
        "trade_date", "symbol", "volume", "turnover", r4("close").alias("close"),
        r4(F.try_divide(F.col("close") - F.col("pc"), F.col("pc")) * 100).alias("pct_change"),
    )


@query(
    "win14_share_of_total",
    with_sql("deals", body=f"""SELECT symbol, count(*) AS deals, {sql4("count(*) * 100.0 / sum(count(*)) OVER ()")} AS share_pct
 FROM deals GROUP BY symbol"""),
)
def _(m):
    per = m.deals.groupBy("symbol").agg(F.count("*").alias("deals"))
    total = m.deals.agg(F.count("*")).scalar()
    return per.select("symbol", "deals", r4(F.col("deals") * 100.0 / total).alias("share_pct"))


@query(
    "win15_duplicate_members",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, n FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n
 FROM lineitem) WHERE n > 1""",
)
def _(m):
    from ticklake.operators.dedupe import duplicate_members

    rows = m.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return duplicate_members(rows, ["l_orderkey", "l_linenumber"], "n")


@query(
    "win16_gaps",
    with_sql("ohlc", body=f"""SELECT symbol, prev AS gap_start, trade_date AS gap_end, CAST(trade_date - prev - 1 AS INTEGER) AS missing_days
 FROM (SELECT symbol, trade_date, lag(trade_date) {W}) AS prev FROM ohlc) WHERE trade_date - prev - 1 > 7"""),
)
def _(m):
    from ticklake.operators.calendar import series_gaps

    return series_gaps(m.trades.select("symbol", "trade_date").distinct(), "symbol", "trade_date", 7)


@query(
    "win17_continuity",
    with_sql("ohlc", body=f"""SELECT symbol, count(*) AS days, CAST(count_if(abs(close - pc) / pc > 0.5) AS BIGINT) AS jumps,
 {sql4("max(abs(close - pc) / pc)")} AS max_move FROM (SELECT *, lag(close) {W}) AS pc FROM ohlc) GROUP BY symbol"""),
)
def _(m):
    move = F.abs(F.try_divide(F.col("close") - F.col("pc"), F.col("pc")))
    return (
        m.closes.withColumn("pc", F.lag("close").over(daily()))
        .groupBy("symbol")
        .agg(F.count("*").alias("days"), F.count_if(move > 0.5).alias("jumps"), r4(F.max(move)).alias("max_move"))
    )


TW = "OVER (PARTITION BY kind ORDER BY ts, event_id"


@query(
    "win01_sma_long_series",
    with_sql("ticks", body=f"""SELECT event_id, kind, CASE WHEN count(price) {TW} ROWS 19 PRECEDING) = 20
 THEN {sql4(f"avg(price) {TW} ROWS 19 PRECEDING)")} END AS sma_20 FROM ticks"""),
)
def _(m):
    t = m.ticks.select("event_id", "kind", "ts", "price")
    out = rolling_long(
        t, ["kind"], ["ts", "event_id"], time_bucket("day")(F.col("ts")), 20,
        {"_n": F.count("price"), "_a": F.avg("price")},
    )
    return out.select("event_id", "kind", F.when(F.col("_n") == 20, r4("_a")).alias("sma_20"))


@query(
    "win03_ema_long_series",
    with_sql("ticks", body=f"""SELECT event_id, kind,
 {sql4(ema_fold_sql("price", 12, "ticks", by="kind", order="ts, event_id"))} AS ema_12 FROM ticks"""),
)
def _(m):
    t = m.ticks.select("event_id", "kind", "ts", "price")
    out = ema_long(t, {"ema_12": ("price", 12)}, ["kind"], ["ts", "event_id"], time_bucket("day")(F.col("ts")))
    return out.select("event_id", "kind", r4("ema_12").alias("ema_12"))


@query(
    "win11_tick_change_long_series",
    with_sql("ticks", body=f"SELECT event_id, kind, {sql4(f'price - lag(price) {TW})')} AS change FROM ticks"),
)
def _(m):
    t = m.ticks.select("event_id", "kind", "ts", "price")
    out = lag_long(t, ["kind"], ["ts", "event_id"], time_bucket("day")(F.col("ts")), "price", "prev")
    return out.select("event_id", "kind", r4(F.col("price") - F.col("prev")).alias("change"))
