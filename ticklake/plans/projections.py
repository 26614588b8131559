"""PRJ, CA, TIME: projections, corporate actions and calendar operators."""

from pyspark.sql import functions as F

from ticklake import schemas
from ticklake.bridge import with_sql
from ticklake.functions import actions as act
from ticklake.functions import envelope as env
from ticklake.functions import finance
from ticklake.functions.rounding import r2, r4, sql2, sql4
from ticklake.functions.text import PRICE_DATES, PRICE_NULLS, parse_date, safe_double, safe_long, yyyymmdd
from ticklake.operators import calendar as cal
from ticklake.operators import topk
from ticklake.operators.adjust import adjust_prices, cumulative_factors
from ticklake.operators.candles import candles
from ticklake.operators.versions import membership
from ticklake.plans import rendering as rd
from ticklake.plans.joins import calendar_of
from ticklake.plans.registry import query
from ticklake.plans.sources import FACTOR_SQL, KIND_SQL, NOT_BLANK
from ticklake.sources import feeds

INGEST = "2024-01-01 18:00:00"
SOURCE = "nse_cm_bhavcopy"
NS = env.DNS_NAMESPACE


def uuid_sql(name: str) -> str:
    h = f"sha1(unhex('{NS}') || encode({name}))"
    return (
        f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || "
        f"translate(substr({h}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr({h}, 18, 3) || '-' || substr({h}, 21, 12)"
    )


def typed_prices(m):
    return feeds.typed(rd.price_cells(m), schemas.PRICE_FEED, PRICE_NULLS, True)


def price_events(m):
    return feeds.price_events(typed_prices(m), SOURCE, "NSE", INGEST)


@query(
    "prj01_normalise",
    with_sql("ohlc", body=f"""SELECT {uuid_sql(f"'{SOURCE}:' || strftime(trade_date, '%Y-%m-%d') || ':' || symbol || ':' || suppkey")} AS event_id, symbol || ':' || suppkey || ':NSE' AS entity_id,
 symbol || ':NSE' AS instrument_id, symbol, 'NSE' AS exchange, trade_date, {sql4("open")} AS open, {sql4("close")} AS close, CASE WHEN suppkey % 3 <> 0 THEN {sql4("close")} END AS settlement_price,
 volume, {sql2("turnover")} AS turnover, CAST(1.0 AS DOUBLE) AS adjustment_factor, CAST(NULL AS DATE) AS adjustment_date, true AS is_trading_day FROM ohlc WHERE {NOT_BLANK}"""),
)
def _(m):
    n = feeds.normalize_prices(price_events(m))
    return n.select(
        "event_id", "entity_id", "instrument_id", "symbol", "exchange", "trade_date", r4("open").alias("open"), r4("close").alias("close"),
        r4("settlement_price").alias("settlement_price"), "volume", r2("turnover").alias("turnover"), "adjustment_factor", "adjustment_date", "is_trading_day",
    )


# The second naming of normalised price columns.
LONG_NAMES = {
    "TckrSymb": "symbol", "TradDt": "trade_date", "OpnPric": "open", "HghPric": "high", "LwPric": "low", "ClsPric": "close",
    "LastPric": "last_price", "PrvsClsgPric": "prev_close", "SttlmPric": "settlement_price", "TtlTradgVol": "total_traded_quantity",
    "TtlTrfVal": "total_traded_value", "TtlNbOfTxsExctd": "total_trades", "ISIN": "isin", "FinInstrmId": "instrument_id",
    "FinInstrmNm": "instrument_name", "Sgmt": "segment", "SctySrs": "series",
}


@query(
    "prj02_second_naming",
    with_sql("ohlc", body=f"""SELECT CASE WHEN {NOT_BLANK} THEN symbol END AS symbol, strftime(trade_date, '%Y-%m-%d') AS trade_date, {sql4("close")} AS close, volume AS total_traded_quantity,
 trades AS total_trades, 'CM' AS segment, 'NSE' AS exchange, CAST(1.0 AS DOUBLE) AS adjustment_factor FROM ohlc"""),
)
def _(m):
    out = typed_prices(m).withColumnsRenamed(LONG_NAMES).withColumns({"exchange": F.lit("NSE"), "adjustment_factor": F.lit(1.0)})
    return out.select("symbol", "trade_date", r4("close").alias("close"), "total_traded_quantity", "total_trades", "segment", "exchange", "adjustment_factor")


@query(
    "prj03_second_feed_mapping",
    with_sql("ohlc", body=f"""SELECT symbol AS "TckrSymb", CAST(suppkey AS VARCHAR) AS "FinInstrmId", strftime(trade_date, '%Y-%m-%d') AS "TradDt", 'BSE' AS "Src", {sql4("close")} AS "ClsPric",
 volume AS "TtlTradgVol", CAST(NULL AS DOUBLE) AS "SttlmPric", CAST(NULL AS BIGINT) AS "OpnIntrst" FROM ohlc"""),
)
def _(m):
    rows = m.ohlc.select(
        F.col("suppkey").cast("string").alias("SC_CODE"), F.col("symbol").alias("SC_NAME"), F.lit("A").alias("SC_GROUP"), F.col("open").alias("OPEN"),
        F.col("high").alias("HIGH"), F.col("low").alias("LOW"), F.col("close").alias("CLOSE"), F.col("close").alias("LAST"), F.col("close").alias("PREVCLOSE"),
        F.col("volume").alias("NO_OF_SHRS"), F.col("turnover").alias("NET_TURNOV"), F.col("trades").alias("NO_TRADES"), F.lit(None).alias("TDCLOINDI"),
        F.lit(None).alias("ISIN_CODE"), "trade_date",
    )
    out = feeds.second_to_first(rows, F.col("trade_date"))
    return out.select("TckrSymb", "FinInstrmId", "TradDt", "Src", r4("ClsPric").alias("ClsPric"), "TtlTradgVol", "SttlmPric", "OpnIntrst")


@query("prj04_deterministic_ids", f"SELECT o_orderkey, {uuid_sql(chr(39) + 'orders:' + chr(39) + ' || o_orderkey')} AS event_id FROM orders")
def _(m):
    return m.table("orders").select("o_orderkey", env.uuid5(F.concat(F.lit("orders:"), "o_orderkey")).alias("event_id"))


@query(
    "prj05_date_formats",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 4 THEN CAST(o_orderdate AS DATE) END AS parsed FROM orders",
)
def _(m):
    k, d = F.col("o_orderkey") % 5, F.col("o_orderdate")
    shown = (
        F.when(k == 0, F.date_format(d, "yyyyMMdd")).when(k == 1, F.date_format(d, "yyyy-MM-dd")).when(k == 2, F.upper(F.date_format(d, "dd-MMM-yyyy")))
        .when(k == 3, F.date_format(d, "dd/MM/yyyy")).otherwise(F.lit("31/31/1999"))
    )
    return m.table("orders").select("o_orderkey", parse_date(shown, (*PRICE_DATES, "d/M/yyyy")).alias("parsed"))


@query(
    "prj06_temporal_encoders",
    """SELECT o_orderkey, epoch_ms(o_orderdate) AS epoch_ms, CAST(o_orderdate::DATE - DATE '1970-01-01' AS INTEGER) AS days, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS ymd FROM orders""",
)
def _(m):
    d = F.col("o_orderdate")
    return m.table("orders").select("o_orderkey", F.unix_millis(d.cast("timestamp")).alias("epoch_ms"), F.unix_date(d.cast("date")).alias("days"), yyyymmdd(d).alias("ymd"))


@query(
    "prj07_safe_casts",
    f"""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN NULL ELSE round(o_totalprice, 2) END AS amount, CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN NULL ELSE CAST(floor(o_totalprice) AS BIGINT) END AS whole FROM orders""",
)
def _(m):
    k, p = F.col("o_orderkey") % 4, F.col("o_totalprice")
    shown = F.when(k == 0, " N/A ").when(k == 1, "12..5").when(k == 2, F.format_number(p, 2)).otherwise(F.concat(F.lit(" "), p.cast("string")))
    return m.table("orders").select("o_orderkey", F.round(safe_double(shown), 2).alias("amount"), safe_long(shown).alias("whole"))


@query("prj08_lineage_columns", "SELECT s_suppkey, s_name, 'v1.0' AS _schema_version, TIMESTAMP '2024-01-01 18:00:00' AS _parsed_at FROM supplier")
def _(m):
    out = env.with_lineage(m.table("supplier").select("s_suppkey", "s_name"), "v1.0", INGEST)
    return out.withColumn("_parsed_at", F.col("_parsed_at").cast("timestamp_ntz"))


@query("prj09_serving_names", with_sql("ohlc", body=f'SELECT symbol AS "TckrSymb", trade_date AS "TradDt", {sql4("close")} AS "ClsPric", volume AS "TtlTradgVol", turnover AS "TtlTrfVal" FROM ohlc'))
def _(m):
    return feeds.to_serving_names(m.ohlc.select("symbol", "trade_date", r4("close").alias("close"), "volume", "turnover"))


@query(
    "prj10_price_slice",
    with_sql("ohlc", body=f"SELECT symbol, trade_date, {sql4('close')} AS close, volume FROM ohlc WHERE symbol = 'S5' AND trade_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' ORDER BY trade_date DESC LIMIT 50 OFFSET 50"),
)
def _(m):
    bars = m.sliced("1996-01-01", "1999-12-31", (5,)).ohlc.select("symbol", "trade_date", r4("close").alias("close"), "volume")
    return topk.page(bars, [F.desc("trade_date")], 2, 50)


@query("prj10_daily_candles", with_sql("ohlc", body=f"SELECT symbol, trade_date AS period_start, {sql4('open')} AS open, {sql4('high')} AS high, {sql4('low')} AS low, {sql4('close')} AS close, volume FROM ohlc"))
def _(m):
    return candles(m.ohlc, "1d").withColumns({c: r4(c) for c in ("open", "high", "low", "close")})


@query(
    "prj11_splits",
    with_sql("ca_text", body=f""", t AS (SELECT *, {KIND_SQL} AS kind FROM ca_text), f AS (SELECT *, {FACTOR_SQL} AS factor FROM t)
 SELECT symbol, ex_date, 1 AS old_shares, CAST(CASE WHEN factor > 0 THEN factor ELSE 1 END AS INTEGER) AS new_shares FROM f WHERE kind = 'SPLIT' AND ex_date >= DATE '1996-01-01'"""),
)
def _(m):
    rows = m.ca_text.filter("ex_date >= DATE'1996-01-01'").withColumn("kind", act.action_type(F.col("purpose"))).filter("kind = 'SPLIT'")
    # the stored ratio reads "new:old"; a missing ratio means 1:1
    n = act.split_shares(F.col("purpose"))
    ratio = F.when(n > 0, F.concat(n, F.lit(":1")))
    parts = F.split(F.coalesce(ratio, F.lit("1:1")), ":")
    return rows.select("symbol", "ex_date", parts[1].cast("int").alias("old_shares"), parts[0].cast("int").alias("new_shares"))


@query("prj11_dividends", with_sql("ca", body="SELECT symbol, ex_date, coalesce(dividend_amount, CAST(0 AS DOUBLE)) AS amount FROM ca WHERE action_type IN ('DIVIDEND', 'OTHER') AND ex_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'"))
def _(m):
    rows = m.sliced("1996-01-01", "1999-12-31").ca.filter(F.col("action_type").isin("DIVIDEND", "OTHER"))
    return rows.select("symbol", "ex_date", F.coalesce("dividend_amount", F.lit(0.0)).alias("amount"))


@query(
    "prj12_constituents_as_of",
    with_sql("constituents", body="SELECT index_name, symbol, partkey, action, weight, effective_date FROM constituents WHERE index_name = 'Brand#2' AND effective_date <= DATE '2024-05-01' ORDER BY weight DESC NULLS LAST, symbol, partkey, effective_date LIMIT 100"),
)
def _(m):
    rows = m.constituents.filter("index_name = 'Brand#2' AND effective_date <= DATE'2024-05-01'").select("index_name", "symbol", "partkey", "action", "weight", "effective_date")
    return rows.orderBy(F.desc_nulls_last("weight"), "symbol", "partkey", "effective_date").limit(100)


@query("prj12_members_by_weight", with_sql("constituents", body="""SELECT index_name, symbol, partkey, weight FROM (SELECT *, row_number() OVER (PARTITION BY index_name, symbol, partkey ORDER BY effective_date DESC) AS rk
 FROM constituents WHERE effective_date <= DATE '2024-08-01') WHERE rk = 1 AND action <> 'REMOVE' ORDER BY weight DESC NULLS LAST, index_name, symbol, partkey LIMIT 100"""))
def _(m):
    now = membership(m.constituents, ["index_name", "symbol", "partkey"], F.lit("2024-08-01").cast("date"), ["action"])
    return now.select("index_name", "symbol", "partkey", "weight").orderBy(F.desc_nulls_last("weight"), "index_name", "symbol", "partkey").limit(100)


@query("prj13_index_changes", with_sql("constituents", body="SELECT index_name, action, symbol, partkey, effective_date FROM constituents WHERE effective_date BETWEEN DATE '2024-03-01' AND DATE '2024-05-30' AND action <> 'REBALANCE'"))
def _(m):
    return m.constituents.filter("effective_date BETWEEN DATE'2024-03-01' AND DATE'2024-05-30' AND action <> 'REBALANCE'").select("index_name", "action", "symbol", "partkey", "effective_date")


@query("prj13_index_list", with_sql("constituents", body="SELECT DISTINCT index_name FROM constituents"))
def _(m):
    return m.constituents.select("index_name").distinct()


@query("prj13_indices_of_symbol", with_sql("constituents", body="SELECT index_name, partkey, weight, effective_date, sector FROM constituents WHERE symbol = 'P7' AND action = 'ADD'"))
def _(m):
    return m.constituents.filter("symbol = 'P7' AND action = 'ADD'").select("index_name", "partkey", "weight", "effective_date", "sector")


@query("prj13_rebalance_history", with_sql("constituents", body="SELECT effective_date, symbol, partkey, action, weight FROM constituents WHERE index_name = 'Brand#17'"))
def _(m):
    return m.constituents.filter("index_name = 'Brand#17'").select("effective_date", "symbol", "partkey", "action", "weight")


@query(
    "prj14_daily_returns",
    with_sql("ohlc", body=f"""SELECT symbol, trade_date, {sql4("close")} AS close, {sql4("pc")} AS prev_close, {sql4("(close - pc) / pc * 100")} AS daily_return_pct, {sql4("close - pc")} AS price_change
 FROM (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY trade_date) AS pc FROM ohlc)"""),
)
def _(m):
    from ticklake.operators.series import daily

    pc = F.col("pc")
    return m.closes.withColumn("pc", F.lag("close").over(daily())).select(
        "symbol", "trade_date", r4("close").alias("close"), r4("pc").alias("prev_close"), r4(F.try_divide(F.col("close") - pc, pc) * 100).alias("daily_return_pct"), r4(F.col("close") - pc).alias("price_change")
    )


@query("prj16_deal_value", with_sql("deals", body=f"SELECT deal_no, deal_line, symbol, quantity, {sql2('quantity * avg_price')} AS total_value FROM deals"))
def _(m):
    return m.deals.select("deal_no", "deal_line", "symbol", "quantity", r2(F.col("quantity") * F.col("avg_price")).alias("total_value"))


RATIOS = ("roe", "roa", "debt_to_equity", "current_ratio", "operating_margin", "net_margin")


def ratio_sql(n, d, scale=""):
    return f"CASE WHEN {n} <> 0 AND {d} <> 0 THEN {n} / {d} {scale} END"


RATIO_SQL = f""", fr AS (SELECT *, {ratio_sql("net_profit", "equity", "* 100")} AS roe, {ratio_sql("net_profit", "total_assets", "* 100")} AS roa, {ratio_sql("total_debt", "equity")} AS debt_to_equity,
 {ratio_sql("current_assets", "current_liabilities")} AS current_ratio, {ratio_sql("operating_profit", "revenue", "* 100")} AS operating_margin, {ratio_sql("net_profit", "revenue", "* 100")} AS net_margin FROM financials)"""


@query("prj17_financial_ratios", with_sql("financials", body=f"{RATIO_SQL} SELECT symbol, period_end_date, {', '.join(f'{sql4(c)} AS {c}' for c in RATIOS)} FROM fr"))
def _(m):
    return finance.with_ratios(m.financials).select("symbol", "period_end_date", *[r4(c).alias(c) for c in RATIOS])


@query(
    "prj18_strong_fundamentals",
    with_sql("financials", "shareholding", body=f"""{RATIO_SQL} SELECT f.symbol, {sql4("roe")} AS roe, {sql4("debt_to_equity")} AS debt_to_equity, {sql4("net_margin")} AS net_margin, promoter FROM fr f JOIN shareholding s
 ON f.symbol = s.symbol AND f.period_end_date = s.quarter_end_date WHERE roe > 15 AND debt_to_equity < 1 AND net_margin > 4 AND promoter > 50"""),
)
def _(m):
    """With a margin limit below the usual one, which no company of the tables reaches."""
    s = m.shareholding.select("symbol", F.col("quarter_end_date").alias("period_end_date"), "promoter")
    rows = finance.strong_fundamentals(finance.with_ratios(m.financials).join(s, ["symbol", "period_end_date"]), net_margin=4.0)
    return rows.select("symbol", r4("roe").alias("roe"), r4("debt_to_equity").alias("debt_to_equity"), r4("net_margin").alias("net_margin"), "promoter")


@query(
    "prj18_undervalued",
    with_sql("financials", "shareholding", "ohlc", body=f"""{RATIO_SQL}, b AS (SELECT f.symbol, f.period_end_date, roe, debt_to_equity, promoter, eps FROM fr f JOIN shareholding s ON f.symbol = s.symbol AND f.period_end_date = s.quarter_end_date
   WHERE roe > 15 AND debt_to_equity < 1 AND promoter > 30 AND eps > 0)
 SELECT b.symbol, period_end_date, {sql4("close / eps")} AS pe FROM b ASOF LEFT JOIN ohlc o ON b.symbol = o.symbol AND b.period_end_date >= o.trade_date WHERE close / eps < 40"""),
)
def _(m):
    from ticklake.operators.asof import asof_join

    s = m.shareholding.select("symbol", F.col("quarter_end_date").alias("period_end_date"), "promoter")
    f = finance.with_ratios(m.financials).filter("eps > 0").join(s, ["symbol", "period_end_date"])
    f = f.select("symbol", "period_end_date", "eps", "roe", "debt_to_equity", "promoter").filter("roe > 15 AND debt_to_equity < 1 AND promoter > 30")
    priced = asof_join(f, m.closes, ["symbol"], "period_end_date", "trade_date", ["close"])
    return finance.undervalued(priced, pe=40.0, promoter=30.0).select("symbol", "period_end_date", r4("pe").alias("pe"))


@query("prj19_financial_anomalies", with_sql("financials", body=f"{RATIO_SQL} SELECT symbol, period_end_date, revenue, net_profit, {sql4('roe')} AS roe, {sql4('debt_to_equity')} AS debt_to_equity FROM fr WHERE revenue < 0 OR net_profit < -10000 OR roe > 100 OR debt_to_equity < 0"))
def _(m):
    rows = finance.with_ratios(m.financials).filter("revenue < 0 OR net_profit < -10000 OR roe > 100 OR debt_to_equity < 0")
    return rows.select("symbol", "period_end_date", "revenue", "net_profit", r4("roe").alias("roe"), r4("debt_to_equity").alias("debt_to_equity"))


CAT_NAMES = ("NIFTY50", "NIFTY100", "NIFTY500", "BANKNIFTY", "NIFTYIT", "NIFTYPHARMA", "MIDCAP50", "SMALLCAP100", "NIFTYNEXT")


@query(
    "prj20_index_category",
    f"""SELECT p_partkey, name, CASE WHEN name IN ('NIFTY50', 'NIFTY100', 'NIFTY500') THEN 'Broad Market' WHEN name LIKE '%BANK%' OR name LIKE '%IT%' OR name LIKE '%PHARMA%' THEN 'Sectoral'
 WHEN name LIKE '%MIDCAP%' OR name LIKE '%SMALLCAP%' THEN 'Market Cap' END AS category FROM (SELECT p_partkey, list_extract([{', '.join(f"'{n}'" for n in CAT_NAMES)}], CAST(p_partkey % {len(CAT_NAMES)} + 1 AS INTEGER)) AS name FROM part)""",
)
def _(m):
    name = F.element_at(F.array(*[F.lit(n) for n in CAT_NAMES]), (F.col("p_partkey") % len(CAT_NAMES) + 1).cast("int"))
    return m.table("part").select("p_partkey", name.alias("name")).withColumn("category", act.index_category(F.col("name")))


@query("prj21_sample", "SELECT o_orderkey, o_totalprice FROM orders WHERE CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 10 = 0")
def _(m):
    """One row in ten, chosen by a hash of the key: the same rows in every run and engine."""
    h = F.conv(F.substr(F.md5(F.col("o_orderkey").cast("string")), F.lit(1), F.lit(8)), 16, 10).cast("bigint")
    return m.table("orders").filter(h % 10 == 0).select("o_orderkey", "o_totalprice")


@query("prj22_pledge_ratio", with_sql("shareholding", body=f"SELECT symbol, quarter_end_date, promoter, pledged, {sql4('pledged / promoter * 100')} AS pledge_ratio FROM shareholding WHERE quarter_end_date = (SELECT max(quarter_end_date) FROM shareholding) AND pledged > 0"))
def _(m):
    rows = finance.latest_period(m.shareholding, "quarter_end_date").filter("pledged > 0")
    return rows.select("symbol", "quarter_end_date", "promoter", "pledged", r4(F.col("pledged") / F.col("promoter") * 100).alias("pledge_ratio"))


@query("prj22_latest_financials", with_sql("financials", body=f"{RATIO_SQL} SELECT symbol, period_end_date, revenue, net_profit, eps, {sql4('roe')} AS roe FROM fr WHERE period_end_date = (SELECT max(period_end_date) FROM financials) ORDER BY revenue DESC, symbol LIMIT 20"))
def _(m):
    rows = finance.with_ratios(finance.latest_period(m.financials, "period_end_date"))
    return rows.select("symbol", "period_end_date", "revenue", "net_profit", "eps", r4("roe").alias("roe")).orderBy(F.desc("revenue"), "symbol").limit(20)


@query("prj23_nest_and_flatten", with_sql("ohlc", body=f"SELECT symbol || ':' || suppkey || ':NSE' AS entity_id, TIMESTAMP '{INGEST}' AS ingest_time, CAST(trade_date AS TIMESTAMP) AS event_time, {sql4('close')} AS close FROM ohlc WHERE {NOT_BLANK}"))
def _(m):
    flat = env.flatten(env.nest(feeds.normalize_prices(price_events(m))))
    return flat.select("entity_id", F.col("ingest_time").cast("timestamp_ntz").alias("ingest_time"), F.col("event_time").cast("timestamp_ntz").alias("event_time"), r4("close").alias("close"))


# --- corporate actions


@query("ca01_action_type", with_sql("ca_text", body=f"SELECT symbol, ex_date, purpose, {KIND_SQL} AS action_type FROM ca_text"))
def _(m):
    return m.ca_text.withColumn("action_type", act.action_type(F.col("purpose")))


@query(
    "ca02_ratios_from_text",
    with_sql("ca_text", body="""SELECT symbol, ex_date, CASE WHEN purpose LIKE 'Face%' THEN 10 // CAST(regexp_extract(purpose, 'To Rs (\\d+)', 1) AS INTEGER)
 WHEN purpose LIKE 'Sub%' THEN 100 // CAST(regexp_extract(purpose, 'to Rs. (\\d+)', 1) AS INTEGER) END AS new_shares,
 CASE WHEN regexp_matches(purpose, '\\d:\\d| for ') THEN CAST(regexp_extract(purpose, '(\\d+)(:| for )(\\d+)', 1) AS INTEGER) END AS bonus_new,
 CASE WHEN regexp_matches(purpose, '\\d:\\d| for ') THEN CAST(regexp_extract(purpose, '(\\d+)(:| for )(\\d+)', 3) AS INTEGER) END AS bonus_held,
 CASE WHEN regexp_matches(lower(purpose), 'rs [0-9.]+(/-)? per share') THEN CAST(regexp_extract(lower(purpose), 'rs ([0-9.]+)(/-)? per share', 1) AS DOUBLE) END AS dividend FROM ca_text"""),
)
def _(m):
    p = F.col("purpose")
    return m.ca_text.select("symbol", "ex_date", act.split_shares(p).alias("new_shares"), act.bonus_new(p).alias("bonus_new"), act.bonus_held(p).alias("bonus_held"), act.dividend_amount(p).alias("dividend"))


@query("ca03_factor_from_text", with_sql("ca_text", body=f", t AS (SELECT *, {KIND_SQL} AS kind FROM ca_text) SELECT symbol, ex_date, {sql4(FACTOR_SQL)} AS factor FROM t"))
def _(m):
    p = F.col("purpose")
    return m.ca_text.select("symbol", "ex_date", r4(act.text_factor(act.action_type(p), p)).alias("factor"))


@query(
    "ca04_typed_factors",
    f"""SELECT p_partkey, {sql4("p_size / 5.0")} AS split_factor, {sql4("(5 + p_size) / 5.0")} AS bonus_factor, CASE WHEN p_size - 3 >= 0 THEN {sql4("1 - (p_size - 3) / p_retailprice")} END AS dividend_factor FROM part""",
)
def _(m):
    n = F.col("p_size")
    return m.table("part").select(
        "p_partkey", r4(act.split_factor(F.lit(5.0), n.cast("double"))).alias("split_factor"), r4(act.bonus_factor(n.cast("double"), F.lit(5.0))).alias("bonus_factor"),
        r4(act.dividend_factor(n - 3.0, F.col("p_retailprice"), strict=False)).alias("dividend_factor"),
    )


@query(
    "ca05_event_factor",
    with_sql("ca", body=f"""SELECT symbol, ex_date, {sql4("CASE WHEN year(ex_date) % 2 = 0 THEN adjustment_factor WHEN action_type = 'SPLIT' THEN 3 WHEN action_type = 'BONUS' THEN 1.25 ELSE 1 END")} AS factor FROM ca"""),
)
def _(m):
    given = F.when(F.year("ex_date") % 2 == 0, F.col("adjustment_factor")).otherwise(F.lit(1.0 + 1e-12))
    kind = F.col("action_type")
    new = F.when(kind == "SPLIT", 3.0).when(kind == "BONUS", 1.0)
    held = F.when(kind == "BONUS", 4.0)
    return m.ca.select("symbol", "ex_date", r4(act.event_factor(kind, given, F.lit(1.0), new, held)).alias("factor"))


CUM = """, f AS (SELECT symbol, ex_date, product(adjustment_factor) OVER (PARTITION BY symbol ORDER BY ex_date DESC, action_type ROWS UNBOUNDED PRECEDING) AS cum FROM ca)"""
RAW_PRODUCT = f"""{CUM}, a AS (SELECT o.symbol, o.trade_date, any_value(o.close) AS close, product(CASE WHEN f.ex_date > o.trade_date THEN cum ELSE 1 END) AS factor, max(f.ex_date) AS adj_date FROM ohlc o LEFT JOIN f ON o.symbol = f.symbol GROUP BY 1, 2)
 SELECT symbol, trade_date, {sql4("close / factor")} AS close, {sql4("factor")} AS adjustment_factor, adj_date AS adjustment_date FROM a"""


def rounded_adjustment(m, **mode):
    out = adjust_prices(m.closes, cumulative_factors(m.ca), **mode)
    return out.select("symbol", "trade_date", r4("close").alias("close"), r4("adjustment_factor").alias("adjustment_factor"), "adjustment_date")


@query("ca06_adjust_product_of_cumulative", with_sql("ohlc", "ca", body=RAW_PRODUCT))
def _(m):
    return rounded_adjustment(m, mode="product_of_cumulative")


def next_event_sql(op: str) -> str:
    return with_sql("ohlc", "ca", body=f"""{CUM} SELECT o.symbol, trade_date, {sql4("close / coalesce(cum, 1)")} AS close, {sql4("coalesce(cum, 1)")} AS adjustment_factor, ex_date AS adjustment_date
 FROM ohlc o ASOF LEFT JOIN f ON o.symbol = f.symbol AND o.trade_date {op} f.ex_date""")


@query("ca07_adjust_next_event_inclusive", next_event_sql("<="))
def _(m):
    return rounded_adjustment(m, inclusive=True)


@query(
    "ca08_adjust_all_price_columns",
    with_sql("ohlc", "ca", body=f"""{CUM}, a AS (SELECT o.symbol, o.trade_date, any_value(o.open) AS open, any_value(o.high) AS high, any_value(o.low) AS low, any_value(o.volume) AS volume,
 product(CASE WHEN f.ex_date > o.trade_date THEN cum ELSE 1 END) AS factor FROM ohlc o LEFT JOIN f ON o.symbol = f.symbol GROUP BY 1, 2)
 SELECT symbol, trade_date, {sql4("open / factor")} AS open, {sql4("high / factor")} AS high, {sql4("low / factor")} AS low, volume FROM a"""),
)
def _(m):
    out = adjust_prices(m.ohlc, cumulative_factors(m.ca), mode="product_of_cumulative")
    return out.select("symbol", "trade_date", r4("open").alias("open"), r4("high").alias("high"), r4("low").alias("low"), "volume")


@query("ca09_adjust_next_event", next_event_sql("<"))
def _(m):
    return rounded_adjustment(m)


@query(
    "ca10_dividend_adjustment",
    with_sql("ohlc", "ca", body=f"""SELECT c.symbol, ex_date, dividend_amount, {sql4("1 - dividend_amount / close")} AS factor FROM ca c JOIN ohlc o ON c.symbol = o.symbol AND ex_date = trade_date WHERE dividend_amount IS NOT NULL"""),
)
def _(m):
    pays = m.ca.filter("dividend_amount IS NOT NULL").select("symbol", "ex_date", "dividend_amount")
    priced = pays.join(m.closes.withColumnRenamed("trade_date", "ex_date"), ["symbol", "ex_date"])
    return priced.select("symbol", "ex_date", "dividend_amount", r4(act.dividend_factor(F.col("dividend_amount"), F.col("close"))).alias("factor"))


@query("ca11_recent_actions", with_sql("ca", body="SELECT action_type, count(*) AS n, min(ex_date) AS first_ex, max(ex_date) AS last_ex FROM ca WHERE ex_date BETWEEN DATE '1999-03-31' - 90 AND DATE '1999-03-31' GROUP BY 1"))
def _(m):
    as_of = F.lit("1999-03-31").cast("date")
    recent = m.ca.filter(F.col("ex_date").between(F.date_sub(as_of, 90), as_of))
    return recent.groupBy("action_type").agg(F.count("*").alias("n"), F.min("ex_date").alias("first_ex"), F.max("ex_date").alias("last_ex"))


# --- calendar


@query("time01_calendar", with_sql("calendar", body="SELECT trade_date, is_trading_day, day_type, holiday_name, weekday, CASE WHEN is_trading_day THEN 'CM,FO,CD' ELSE '' END AS open_segments FROM calendar"))
def _(m):
    open_now = F.filter("segments", lambda s: s["is_open"])
    return calendar_of(m).withColumn("open_segments", F.array_join(F.transform(open_now, lambda s: s["segment"]), ",")).drop("segments")


@query(
    "time02_is_trading_day",
    with_sql("calendar", body="""SELECT d, n, coalesce(c.is_trading_day, isodow(d) < 6) AS is_trading_day FROM (SELECT CAST(l_shipdate AS DATE) + 120 AS d, count(*) AS n FROM lineitem GROUP BY 1) LEFT JOIN calendar c ON c.trade_date = d"""),
)
def _(m):
    days = m.table("lineitem").groupBy(F.date_add(F.to_date("l_shipdate"), 120).alias("d")).agg(F.count("*").alias("n"))
    return cal.with_trading_flag(days, "d", calendar_of(m))


def shift_sql(n: int) -> str:
    agg, cmp = ("min", ">") if n > 0 else ("max", "<")
    rank = "ASC" if n > 0 else "DESC"
    return with_sql("calendar", body=f""", t AS (SELECT trade_date AS td FROM calendar WHERE is_trading_day),
 j AS (SELECT c.trade_date, c.is_trading_day, td, row_number() OVER (PARTITION BY c.trade_date ORDER BY td {rank}) AS rk FROM calendar c JOIN t ON td {cmp} c.trade_date AND abs(td - c.trade_date) <= 60)
 SELECT c.trade_date, c.is_trading_day, j.td AS shifted FROM calendar c LEFT JOIN j ON c.trade_date = j.trade_date AND rk = {abs(n)}""")


@query("time03_next_trading_day", shift_sql(1))
def _(m):
    return cal.trading_day_shift(calendar_of(m), 1)


@query("time03_three_trading_days_back", shift_sql(-3))
def _(m):
    return cal.trading_day_shift(calendar_of(m), -3)


@query("time04_days_in_range", with_sql("calendar", body="SELECT day_type, count(*) AS n, min(trade_date) AS first_day, max(trade_date) AS last_day FROM calendar WHERE trade_date BETWEEN DATE '1997-02-01' AND DATE '1999-06-30' GROUP BY 1"))
def _(m):
    inside = calendar_of(m).filter(F.col("trade_date").between("1997-02-01", "1999-06-30"))
    return inside.groupBy("day_type").agg(F.count("*").alias("n"), F.min("trade_date").alias("first_day"), F.max("trade_date").alias("last_day"))


@query("time07_interval_buckets", with_sql("ticks", body="SELECT CAST(floor(epoch(ts) / 900) AS BIGINT) AS bucket, count(*) AS n FROM ticks GROUP BY 1"))
def _(m):
    seconds = int(cal.interval_minutes("15m") * 60)
    return m.ticks.groupBy(F.floor(F.unix_timestamp("ts") / seconds).alias("bucket")).agg(F.count("*").alias("n"))
