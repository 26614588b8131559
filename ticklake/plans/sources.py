"""SRC: ingest of feed files and documents, each read back from a rendered copy."""

from pyspark.sql import functions as F

from ticklake.bridge import with_sql
from ticklake.functions.envelope import flatten, nest
from ticklake.functions.rounding import r4, sql4
from ticklake.functions.text import slice_date
from ticklake.plans import rendering as rd
from ticklake.plans.registry import query
from ticklake.session import fresh_path
from ticklake.sources import documents as docs
from ticklake.sources import feeds
from ticklake.sources.lake import read_csv, read_lake

PRICES = ("open", "high", "low", "close")
NOT_BLANK = f"NOT ({rd.BLANK_SYMBOL})"


@query(
    "src01_price_feed",
    with_sql("ohlc", body=f"""SELECT symbol AS "TckrSymb", CAST(suppkey AS VARCHAR) AS "FinInstrmId", strftime(trade_date, '%Y-%m-%d') AS "TradDt", {sql4("open")} AS "OpnPric",
 {sql4("close")} AS "ClsPric", CASE WHEN suppkey % 5 <> 0 THEN {sql4("close")} END AS "LastPric", CASE WHEN suppkey % 3 <> 0 THEN {sql4("close")} END AS "SttlmPric",
 volume AS "TtlTradgVol", trades AS "TtlNbOfTxsExctd" FROM ohlc WHERE {NOT_BLANK}"""),
)
def _(m):
    df = feeds.read_prices(m.spark, rd.price_file(m))
    prices = [r4(c).alias(c) for c in ("OpnPric", "ClsPric", "LastPric", "SttlmPric")]
    return df.select("TckrSymb", "FinInstrmId", "TradDt", *prices, "TtlTradgVol", "TtlNbOfTxsExctd")


@query(
    "src02_second_price_feed",
    with_sql("ohlc", body=f"""SELECT CAST(suppkey AS VARCHAR) AS code, symbol AS name, {sql4("close")} AS close, volume, trades,
 CASE WHEN suppkey % 4 <> 0 THEN 'IN' || suppkey END AS isin FROM ohlc WHERE {NOT_BLANK}"""),
)
def _(m):
    df = feeds.read_second_prices(m.spark, rd.second_price_file(m))
    return df.select(
        F.col("SC_CODE").alias("code"), F.col("SC_NAME").alias("name"), r4("CLOSE").alias("close"), F.col("NO_OF_SHRS").alias("volume"),
        F.col("NO_TRADES").alias("trades"), F.col("ISIN_CODE").alias("isin"),
    )


@query(
    "src03_lenient_price_feed",
    with_sql("ohlc", body=f"""SELECT symbol, strftime(trade_date, '%Y-%m-%d') AS trad_dt, CASE WHEN suppkey % 9 = 0 THEN '0' ELSE CAST(suppkey AS VARCHAR) END AS instrument,
 CASE WHEN suppkey % 6 <> 0 THEN {sql4("close")} END AS close, volume FROM ohlc WHERE {NOT_BLANK}"""),
)
def _(m):
    cells = rd.price_cells(m).withColumns(
        {
            "ClsPric": F.when(F.col("FinInstrmId").cast("int") % 6 == 0, F.lit("n.a.")).otherwise(F.col("ClsPric")),
            "FinInstrmId": F.when(F.col("FinInstrmId").cast("int") % 9 == 0, F.lit(" ")).otherwise(F.col("FinInstrmId")),
        }
    )
    df = feeds.read_prices(m.spark, rd.write_csv(m, cells, "lenient"), strict=False)
    return df.select(
        F.col("TckrSymb").alias("symbol"), F.col("TradDt").alias("trad_dt"), F.col("FinInstrmId").alias("instrument"), r4("ClsPric").alias("close"),
        F.col("TtlTradgVol").alias("volume"),
    )


@query(
    "src04_symbol_master_feed",
    f"""SELECT 'C' || c_custkey || ':NSE' AS instrument_id, 'C' || c_custkey AS symbol, c_name AS company_name,
 CASE WHEN c_custkey % 7 <> 0 THEN DATE '1990-01-01' + CAST(c_custkey % 3000 AS INTEGER) END AS listing_date, {sql4("c_acctbal")} AS paid_up_value,
 CASE WHEN c_custkey % 5 <> 0 THEN c_custkey % 100 + 1 END AS lot_size, 'ACTIVE' AS status, DATE '2024-01-01' AS valid_from FROM customer""",
)
def _(m):
    k = F.col("c_custkey")
    listed = F.date_add(F.lit("1990-01-01").cast("date"), (k % 3000).cast("int"))
    cells = m.table("customer").select(
        F.concat(F.lit("C"), k).alias("SYMBOL"), F.col("c_name").alias("NAME OF COMPANY"), F.lit("EQ").alias("SERIES"),
        F.when(k % 7 == 0, F.lit("soon")).otherwise(F.upper(F.date_format(listed, "dd-MMM-yyyy"))).alias("DATE OF LISTING"),
        rd.text("c_acctbal").alias("PAID UP VALUE"), F.when(k % 5 == 0, F.lit("NA")).otherwise(rd.text(k % 100 + 1)).alias("MARKET LOT"),
        F.concat(F.lit("INE"), k).alias("ISIN NUMBER"), F.lit("10").alias("FACE VALUE"),
    )
    again = cells.filter("SYMBOL LIKE '%11'").withColumns({c: F.lit(c) for c in cells.columns})
    path = rd.write_csv(m, cells.unionByName(again), "master")
    return feeds.read_master(m.spark, path, "2024-01-01").select(
        "instrument_id", "symbol", "company_name", "listing_date", r4("paid_up_value").alias("paid_up_value"), "lot_size", "status", "valid_from"
    )


KIND_SQL = """CASE WHEN purpose IS NULL THEN NULL WHEN regexp_matches(lower(purpose), 'split|sub-division|subdivision') THEN 'SPLIT'
 WHEN regexp_matches(lower(purpose), 'bonus|capitalisation') THEN 'BONUS' WHEN regexp_matches(lower(purpose), 'dividend|div') THEN 'DIVIDEND'
 WHEN regexp_matches(lower(purpose), 'rights') THEN 'RIGHTS' WHEN regexp_matches(lower(purpose), 'interest') THEN 'INTEREST_PAYMENT'
 WHEN regexp_matches(lower(purpose), 'egm|agm|meeting') THEN 'EGMMEETING' WHEN regexp_matches(lower(purpose), 'demerger|de-merger') THEN 'DEMERGER'
 WHEN regexp_matches(lower(purpose), 'merger|amalgamation') THEN 'MERGER' WHEN regexp_matches(lower(purpose), 'buy-back|buyback') THEN 'BUYBACK' ELSE 'OTHER' END"""
FACTOR_SQL = """CASE WHEN kind = 'SPLIT' AND regexp_matches(lower(purpose), 'rs\\.?\\s*\\d+.*to\\s*rs')
  THEN CAST(trunc(CAST(regexp_extract(lower(purpose), 'rs\\.?\\s*(\\d+)', 1) AS DOUBLE) / CAST(regexp_extract(lower(purpose), 'to\\s*rs\\.?\\s*(\\d+)', 1) AS DOUBLE)) AS DOUBLE)
 WHEN kind = 'BONUS' THEN (CAST(regexp_extract(purpose, '(\\d+)(:| for )(\\d+)', 3) AS DOUBLE) + CAST(regexp_extract(purpose, '(\\d+)(:| for )(\\d+)', 1) AS DOUBLE))
  / CAST(regexp_extract(purpose, '(\\d+)(:| for )(\\d+)', 3) AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END"""


@query(
    "src05_action_feed",
    with_sql("ca_text", body=f""", t AS (SELECT *, {KIND_SQL} AS kind FROM ca_text)
 SELECT symbol, ex_date, ex_date + 2 AS record_date, kind AS action_type, {sql4(FACTOR_SQL)} AS adjustment_factor,
 CASE WHEN kind = 'DIVIDEND' THEN CAST(regexp_extract(purpose, 'Rs (\\d+\\.\\d+)', 1) AS DOUBLE) END AS dividend_amount FROM t"""),
)
def _(m):
    ex = F.col("ex_date")
    y = F.year(ex)
    # dates appear in the feed's several formats
    shown = F.when(y % 3 == 0, F.date_format(ex, "dd-MMM-yyyy")).when(y % 3 == 1, F.date_format(ex, "dd/MM/yyyy")).otherwise(F.date_format(ex, "yyyy-MM-dd"))
    blank = F.lit("-")
    cells = m.ca_text.select(
        F.col("symbol").alias("SYMBOL"), F.col("symbol").alias("COMPANY"), F.lit("EQ").alias("SERIES"), F.lit("10").alias("FACE VALUE"),
        F.col("purpose").alias("PURPOSE"), shown.alias("EX-DATE"), F.date_format(F.date_add(ex, 2), "dd-MM-yyyy").alias("RECORD DATE"),
        blank.alias("BC START DATE"), blank.alias("BC END DATE"), blank.alias("ND START DATE"), blank.alias("ND END DATE"), blank.alias("ACTUAL PAYMENT DATE"),
    )
    out = feeds.read_actions(m.spark, rd.write_csv(m, cells, "actions"))
    return out.select("symbol", "ex_date", "record_date", "action_type", r4("adjustment_factor").alias("adjustment_factor"), "dividend_amount")


def action_docs(m):
    item = F.array(F.struct(
        "symbol", F.col("symbol").alias("comp"), F.col("purpose").alias("subject"), F.date_format("ex_date", "dd-MMM-yyyy").alias("exDate"),
        F.lit("EQ").alias("series"),
    ))
    wrapped = F.to_json(F.struct(item.alias("data")))
    doc = F.when(F.year("ex_date") % 2 == 0, F.to_json(item)).otherwise(wrapped)
    return m.ca_text.select(F.concat_ws("/", "symbol", "ex_date").alias("doc_id"), doc.alias("doc"))


@query(
    "src06_action_documents",
    with_sql("ca_text", body="SELECT symbol, symbol AS company_name, purpose, ex_date FROM ca_text"),
)
def _(m):
    return docs.corporate_actions(action_docs(m)).select("symbol", "company_name", "purpose", "ex_date")


@query(
    "src06_action_documents_on_date",
    with_sql("ca_text", body="SELECT symbol, purpose, ex_date FROM ca_text WHERE ex_date = DATE '1998-01-01'"),
)
def _(m):
    return docs.corporate_actions(action_docs(m), F.lit("1998-01-01").cast("date")).select("symbol", "purpose", "ex_date")


@query(
    "src07_deal_documents",
    with_sql("deals", body=f"""SELECT symbol, client_name, deal_date, deal_type, side AS transaction_type, CASE WHEN side = 'BUY' THEN quantity ELSE quantity // 10 END AS quantity,
 {sql4("avg_price")} AS avg_price FROM deals, (VALUES ('BUY'), ('SELL')) s(side) WHERE side = 'BUY' OR quantity // 10 > 0"""),
)
def _(m):
    q = F.col("quantity")
    usual = F.struct(
        "symbol", F.col("client_name").alias("clientName"), q.alias("buyQty"), F.expr("quantity div 10").alias("sellQty"),
        F.col("avg_price").alias("buyAvgPrice"), F.col("avg_price").alias("sellAvgPrice"), F.upper(F.date_format("deal_date", "dd-MMM-yyyy")).alias("dealDate"),
    )
    other = F.struct(
        F.col("symbol").alias("Symbol"), F.col("client_name").alias("ClientName"), q.alias("BuyQty"), F.expr("quantity div 10").alias("SellQty"),
        F.col("avg_price").alias("BuyAvgPrice"), F.col("avg_price").alias("SellAvgPrice"), F.date_format("deal_date", "dd-MMM-yyyy").alias("DealDate"),
    )
    doc = F.when(q % 2 == 0, F.to_json(F.array(usual))).otherwise(F.to_json(F.array(other)))
    rows = m.deals.select(F.lit("").alias("doc_id"), doc.alias("doc"), "deal_type")
    return docs.deals(rows, F.col("deal_type")).withColumn("avg_price", r4("avg_price"))


@query(
    "src08_deal_feed",
    with_sql("deals", body=f"""SELECT deal_type, symbol, client_name, transaction_type, quantity * 1000 AS quantity,
 CASE WHEN quantity % 11 = 0 THEN CAST(0.0 AS DOUBLE) ELSE round(value, 2) END AS avg_price FROM deals WHERE quantity <> 13"""),
)
def _(m):
    q = F.col("quantity")
    cells = m.deals.select(
        "deal_type", F.col("symbol").alias("Symbol"), F.col("client_name").alias("ClientName"), F.lower("transaction_type").alias("Buy/Sell"),
        F.when(q == 13, F.lit("n/a")).otherwise(F.format_number(q * 1000, 0)).alias("QuantityTraded"),
        F.when(q % 11 == 0, F.lit("?")).otherwise(F.format_number("value", 2)).alias("TradePrice/Wght.Avg.Price"), F.lit("-").alias("Remarks"),
    )
    path = fresh_path(m.spark, "deals")
    cells.write.partitionBy("deal_type").option("header", True).option("quoteAll", True).csv(path)
    both = [feeds.read_deals(m.spark, f"{path}/deal_type={kind}", kind).withColumn("deal_type", F.lit(kind)) for kind in ("BULK", "BLOCK")]
    return both[0].unionByName(both[1]).select("deal_type", "symbol", "client_name", "transaction_type", "quantity", "avg_price")


@query(
    "src09_constituent_documents",
    with_sql("constituents", body="""SELECT index_name, symbol, company_name, effective_date, action, weight, CASE WHEN partkey % 6 <> 0 THEN 'IN' || partkey END AS isin,
 CAST(floor(partkey * 1.5) AS BIGINT) AS shares_for_index, sector FROM constituents WHERE partkey % 5 <> 0"""),
)
def _(m):
    k = F.col("partkey")
    isin = F.when(k % 6 == 0, F.lit("-")).otherwise(F.concat(F.lit("IN"), k))
    nested = F.struct(
        "symbol", F.when(k % 5 == 0, "GB").when(k % 5 == 1, "BE").otherwise("EQ").alias("series"),
        F.struct(isin.alias("isin"), F.col("company_name").alias("companyName")).alias("meta"),
        F.col("weight").cast("string").alias("indexWeight"), F.lit(1.0).alias("weightage"), (k * 1.5).alias("sharesForIndex"), F.col("sector").alias("sector"),
    )
    flat = F.struct(
        "symbol", F.when(k % 5 == 0, "GB").otherwise("EQ").alias("series"), isin.alias("isin"), F.col("company_name").alias("companyName"),
        F.col("weight").alias("weightage"), (k * 1.5).alias("sharesForIndex"), "sector",
    )
    # null members are left out of rendered JSON, so a missing weight is only rendered in the flat form
    doc = F.when(F.col("weight").isNotNull() & (k % 2 == 0), F.to_json(F.struct(F.array(nested).alias("data")))).otherwise(
        F.to_json(F.struct(F.array(flat).alias("data")))
    )
    rows = m.constituents.select(doc.alias("doc"), "index_name", "effective_date", "action")
    out = docs.constituents(rows, F.col("index_name"), F.col("effective_date"), F.col("action"))
    return out.select("index_name", "symbol", "company_name", "effective_date", "action", "weight", "isin", "shares_for_index", "sector")


@query(
    "src10_macro_flat_documents",
    with_sql("macro", body="""SELECT indicator_date, indicator_code, 'n ' || indicator_code AS indicator_name, value, indicator_code || ':' || strftime(indicator_date, '%Y-%m-%d') AS entity_id FROM macro"""),
)
def _(m):
    item = F.struct(
        F.date_format("indicator_date", "yyyy-MM-dd").alias("indicator_date"), "indicator_code", F.concat(F.lit("n "), "indicator_code").alias("indicator_name"),
        F.lit("C").alias("indicator_category"), F.lit("INR").alias("unit"), F.lit("monthly").alias("frequency"), F.lit("feed").alias("source"), "value",
    )
    rows = m.macro.select(F.to_json(F.struct(F.array(item).alias("indicators"))).alias("doc"))
    return docs.macro_flat(rows).select("indicator_date", "indicator_code", "indicator_name", "value", "entity_id")


@query(
    "src11_macro_series_documents",
    with_sql("macro", body="""SELECT indicator_code, CASE WHEN month(indicator_date) <> 2 THEN indicator_date END AS indicator_date,
 CASE WHEN month(indicator_date) <> 3 THEN value END AS value, 'feed' AS source FROM macro"""),
)
def _(m):
    mon = F.month("indicator_date")
    point = F.struct(
        F.when(mon == 2, F.lit("Feb")).otherwise(F.date_format("indicator_date", "yyyy-MM-dd")).alias("date"),
        F.when(mon == 3, F.lit("x")).otherwise(rd.text("value")).alias("value"),
    )
    # a series lists one year of one indicator: at most twelve points
    yearly = m.macro.groupBy("indicator_code", F.year("indicator_date").alias("y")).agg(F.collect_list(point).alias("series"))
    ind = F.struct(F.col("indicator_code").alias("code"), F.lit("n").alias("name"), F.lit("c").alias("category"), F.lit("u").alias("unit"), "series")
    rows = yearly.select(F.to_json(F.struct(F.lit("feed").alias("source"), F.array(ind).alias("indicators"))).alias("doc"))
    return docs.macro_series(rows).select("indicator_code", "indicator_date", "value", "source")


@query(
    "src12_holiday_documents",
    """SELECT s.segment, make_date(y, n_nationkey % 12 + 1, n_nationkey % 28 + 1) AS holiday_date, n_name AS holiday_name FROM nation,
 (SELECT DISTINCT year(o_orderdate) AS y FROM orders), (VALUES ('CM'), ('FO'), ('CD')) s(segment) WHERE s.segment <> 'CD' OR n_nationkey % 2 = 0""",
)
def _(m):
    orders = m.table("orders")
    first, last = (orders.agg(f(F.year("o_orderdate"))).scalar() for f in (F.min, F.max))
    per_year = m.holidays.withColumn("y", F.explode(F.sequence(first, last))).withColumn("d", F.make_date("y", "mm", "dd"))
    i = F.col("dd") % 5
    shown = (
        F.when(i == 0, F.date_format("d", "dd-MMM-yyyy")).when(i == 1, F.date_format("d", "dd-MMMM-yyyy")).when(i == 2, F.date_format("d", "dd/MM/yyyy"))
        .when(i == 3, F.date_format("d", "dd-MMM")).otherwise(F.date_format("d", "yyyy-MM-dd"))
    )
    one = F.array(F.struct(shown.alias("tradingDate"), F.col("holiday_name").alias("description")))
    odd = F.when(F.col("dd") % 2 == 1, one)
    rows = per_year.select("y", F.to_json(F.struct(one.alias("CM"), one.alias("FO"), odd.alias("CD"))).alias("doc"))
    return docs.holidays(rows, F.col("y"))


@query(
    "src13_option_chain_documents",
    f"""SELECT 'P' || p_partkey AS underlying, {sql4("p_retailprice")} AS underlying_value, strftime(DATE '2024-01-25' + CAST(p_size AS INTEGER), '%Y-%m-%d') AS expiry_date,
 CAST(p_size * 100 AS DOUBLE) AS strike_price, t AS option_type, {sql4("p_retailprice / p_size")} AS last_price, p_partkey % 500 AS open_interest,
 CASE WHEN t = 'CE' THEN CAST(0.5 AS DOUBLE) END AS delta FROM part, (VALUES ('CE'), ('PE')) s(t) WHERE t = 'CE' OR p_partkey % 3 <> 0""",
)
def _(m):
    k = F.col("p_partkey")
    last = F.col("p_retailprice") / F.col("p_size")
    call = F.struct(last.alias("lastPrice"), (k % 500).alias("openInterest"), F.lit(0.5).alias("delta"))
    put = F.struct(last.alias("lastPrice"), (k % 500).alias("openInterest"))
    expiry = F.date_format(F.date_add(F.lit("2024-01-25").cast("date"), F.col("p_size")), "dd-MMM-yyyy")
    item = F.struct(expiry.alias("expiryDate"), (F.col("p_size") * 100).alias("strikePrice"), call.alias("CE"), F.when(k % 3 != 0, put).alias("PE"))
    doc = F.to_json(F.struct(F.struct(F.col("p_retailprice").alias("underlyingValue"), F.array(item).alias("data")).alias("records")))
    rows = m.table("part").select(doc.alias("doc"), F.concat(F.lit("P"), k).alias("u"))
    out = docs.option_chain(rows, F.col("u"), F.lit("2024-01-01 10:00:00").cast("timestamp"))
    return out.select(
        "underlying", r4("underlying_value").alias("underlying_value"), "expiry_date", "strike_price", "option_type", r4("last_price").alias("last_price"), "open_interest", "delta"
    )


@query(
    "src14_shareholding_html",
    with_sql("shareholding", body="""SELECT symbol || '/' || strftime(quarter_end_date, '%Y-%m-%d') AS doc_id, promoter AS promoter_shareholding_percent, 100 - promoter AS public_shareholding_percent,
 fii AS fii_shareholding_percent, dii AS dii_shareholding_percent, institutional AS mutual_fund_shareholding_percent FROM shareholding"""),
)
def _(m):
    row = lambda a, b: F.concat(F.lit(f"<TR class='r'><td>{a}</td>\n<td> "), rd.text(b), F.lit("%</td></TR>"))
    html = F.concat(
        F.lit("<html><body><p>Holding <b>pattern</b></p><table><tr><th>Category</th><th>%</th></tr>"),
        row("Promoter &amp; Promoter Group", F.col("promoter") + 1), row("<b>Promoter</b> group (restated)", "promoter"), row("Public", 100 - F.col("promoter")),
        row("FIIs", "fii"), F.lit("</table><table border=1>"), row("DIIs", "dii"), row("Mutual Funds", "institutional"),
        F.lit("<tr><td>Bank</td></tr><tr><td>Employee trust</td><td>n.a.</td></tr></table></body></html>"),
    )
    rows = m.shareholding.select(F.concat_ws("/", "symbol", F.date_format("quarter_end_date", "yyyy-MM-dd")).alias("doc_id"), html.alias("doc"))
    out = docs.shareholding_tables(rows)
    return out.select(
        "doc_id", "promoter_shareholding_percent", "public_shareholding_percent", "fii_shareholding_percent", "dii_shareholding_percent", "mutual_fund_shareholding_percent"
    )


def xbrl_docs(m):
    fact = lambda tag, value, more="": F.concat(F.lit(f"<in:{tag} contextRef='c1' {more}>"), rd.text(value), F.lit(f"</in:{tag}>"))
    xml = F.concat(
        F.lit("<xbrl xmlns='http://www.xbrl.org/2003/instance' xmlns:in='urn:in'><context id='c1'><entity><identifier scheme='s'>http://x/"), "symbol",
        F.lit("</identifier></entity><period><startDate>2000-01-01</startDate><endDate>"), F.date_format("period_end_date", "yyyy-MM-dd"),
        F.lit("</endDate></period></context><unit id='inr'><measure>iso4217:INR</measure></unit><unit id='ps'><measure>INR/shares</measure></unit>"),
        fact("LevelOfRoundingUsedInFinancialStatements", F.when(F.col("quarter") % 2 == 0, "Lakhs").otherwise("Actual")),
        fact("RevenueFromOperations", "revenue", "unitRef='inr' decimals='-3'"),
        fact("ProfitLossForPeriod", "net_profit", "unitRef='inr' decimals='INF'"),
        fact("BasicEarningsLossPerShareFromContinuingOperations", "eps", "unitRef='ps' decimals='2'"),
        fact("GrossAssetsReported", "total_assets", "unitRef='inr'"),
        fact("TotalAssets", "total_assets", "unitRef='inr'"),
        fact("OtherRevenueItem", F.lit("1,000"), "unitRef='inr'"),
        fact("ScripCode", "symbol"), fact("ScripCode", F.col("quarter")),
        F.lit("</xbrl>"),
    )
    return m.financials.select(F.concat_ws("/", "symbol", "year", "quarter").alias("doc_id"), xml.alias("doc"))


@query(
    "src15_xbrl_records",
    with_sql("financials", body=f"""SELECT symbol || '/' || year || '/' || quarter AS doc_id, symbol, period_end_date, {sql4("revenue / 1000")} AS revenue,
 {sql4("net_profit / (CASE WHEN quarter % 2 = 0 THEN 100000 ELSE 1 END)")} AS net_profit, eps, {sql4("total_assets / (CASE WHEN quarter % 2 = 0 THEN 100000 ELSE 1 END)")} AS total_assets,
 symbol || '|' || quarter || '|1,000' AS extra FROM financials"""),
)
def _(m):
    out = docs.xbrl_records(docs.xbrl_facts(xbrl_docs(m)))
    md = F.col("metadata")
    return out.select(
        "doc_id", "symbol", "period_end_date", r4("revenue").alias("revenue"), r4("net_profit").alias("net_profit"), "eps", r4("total_assets").alias("total_assets"),
        F.concat_ws("|", md["ScripCode"], md["ScripCode_1"], md["OtherRevenueItem"]).alias("extra"),
    )


@query(
    "src16_results_master",
    with_sql("financials", body="""SELECT symbol, CAST(CASE WHEN year % 4 = 0 THEN 0 ELSE year END AS INTEGER) AS year, period_end_date, quarter,
 CASE WHEN quarter <> 2 THEN 'http://x/' || symbol END AS document_url, '2024-01-02 10:11:12' AS "broadCastDate" FROM financials WHERE quarter <> 3"""),
)
def _(m):
    q = F.col("quarter")
    rows = m.financials.select(
        "symbol", F.when(F.col("year") % 4 == 0, "unknown").otherwise(rd.text("year")).alias("financialYear"), F.date_format("period_end_date", "dd-MMM-yyyy").alias("toDate"),
        F.when(q == 4, "Annual").otherwise(F.concat(F.lit("Q"), q, F.lit(" results"))).alias("period"),
        F.when(q == 3, "Un-Audited").otherwise(" Audited ").alias("audited"), F.when(q == 2, "-").otherwise(F.concat(F.lit("http://x/"), "symbol")).alias("** XBRL"),
        F.lit("02-Jan-2024 10:11:12").alias("broadCastDate"),
    )
    out = feeds.normalize_results(rows, only_audited=True)
    return out.select("symbol", "year", "period_end_date", "quarter", "document_url", "broadCastDate")


@query(
    "src17_lake_read",
    with_sql("ohlc", body=f"SELECT symbol, trade_date, {sql4('close')} AS close, CAST(year(trade_date) AS INTEGER) AS year FROM ohlc WHERE year(trade_date) = 1997"),
)
def _(m):
    path = fresh_path(m.spark, "bars")
    m.closes.withColumn("year", F.year("trade_date")).write.partitionBy("year").parquet(path)
    return read_lake(m.spark, path).filter("year = 1997").select("symbol", "trade_date", r4("close").alias("close"), "year")


@query("src18_csv_read", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def _(m):
    path = fresh_path(m.spark, "supplier")
    sup = m.table("supplier")
    sup.write.option("header", True).csv(path)
    return read_csv(m.spark, path, sup.schema)


@query("src19_action_load_unwraps_payload", with_sql("ca", body=f"SELECT symbol, ex_date, action_type, {sql4('adjustment_factor')} AS adjustment_factor FROM ca"))
def _(m):
    path = fresh_path(m.spark, "ca-events")
    wrapped = m.ca.withColumns({"event_id": F.concat_ws(":", "symbol", "ex_date"), "source": F.lit("feed")})
    nest(wrapped).write.parquet(path)
    out = flatten(read_lake(m.spark, path))
    return out.select("symbol", "ex_date", "action_type", r4("adjustment_factor").alias("adjustment_factor"))


@query("src20_raw_slice_by_date", with_sql("ohlc", body=f"SELECT symbol, trade_date, {sql4('close')} AS close FROM ohlc WHERE trade_date IN (DATE '1997-03-04', DATE '1998-05-06')"))
def _(m):
    wanted = [slice_date(F.lit(d)) for d in ("1997-03-04", "19980506")]
    bars = m.sliced("1997-03-04", "1998-05-06").closes
    return bars.filter(F.col("trade_date").isin(*wanted)).withColumn("close", r4("close"))


@query(
    "src22_batch_documents",
    with_sql("ca_text", body="""SELECT kind, count(*) AS n FROM (SELECT 'row' AS kind FROM ca_text WHERE substr(symbol, 2) NOT IN ('3', '7')
 UNION ALL SELECT 'not a JSON document' FROM ca_text WHERE substr(symbol, 2) IN ('3', '7')) GROUP BY 1"""),
)
def _(m):
    path = fresh_path(m.spark, "batch")
    broken = F.col("doc_id").rlike("^S[37]/")
    rows = action_docs(m).withColumn("doc", F.when(broken, F.lit("{oops")).otherwise(F.col("doc")))
    # one document per line here; read_documents reads one per file
    rows.select("doc").write.text(path)
    read = m.spark.read.text(path).select(F.lit("f").alias("doc_id"), F.col("value").alias("doc"))
    good = docs.corporate_actions(read).select(F.lit("row").alias("kind"))
    bad = docs.document_errors(read).select(F.col("error").alias("kind"))
    return good.unionByName(bad).groupBy("kind").agg(F.count("*").alias("n"))


FILES_SQL = """SELECT symbol, format, records, error FROM (SELECT 'S' || s_suppkey AS symbol, s_suppkey % 7 AS k, 1 + s_suppkey % 3 AS n FROM supplier), (VALUES
 (0, 'json', NULL), (1, 'json', 'not a JSON document'), (2, 'xml', NULL), (3, 'xml', 'bad'), (4, 'html', NULL), (5, 'html', 'no holder rows'), (6, 'empty', 'empty document')) t(kind, format, error),
 LATERAL (SELECT CASE kind WHEN 0 THEN n WHEN 2 THEN n WHEN 4 THEN 1 ELSE 0 END AS records) WHERE k = kind"""


@query("src22_folder_of_files", FILES_SQL)
def _(m):
    """A folder with one file per document, nested by kind, of three formats; some broken, one kind empty."""
    k, n = F.col("s_suppkey") % 7, (1 + F.col("s_suppkey") % 3).cast("int")
    name = F.concat(F.lit("S"), "s_suppkey")
    item = F.concat(F.lit('{"symbol": "'), name, F.lit('", "exDate": "01-Jan-2024"}'))
    fact = '<RevenueFromOperations contextRef="c" decimals="0">100</RevenueFromOperations>'
    context = '<?xml version="1.0"?><xbrl><context id="c"><entity><identifier>5</identifier></entity><period><endDate>2024-03-31</endDate></period></context>'
    doc = (
        F.when(k == 0, F.concat(F.lit('{"data": ['), F.array_join(F.array_repeat(item, n), ", "), F.lit("]}"))).when(k == 1, "{oops")
        .when(k == 2, F.concat(F.lit(context), F.repeat(F.lit(fact), n), F.lit("</xbrl>"))).when(k == 3, context)
        .when(k == 4, "<html><table><tr><td>Promoter</td><td>55.5%</td></tr></table></html>").when(k == 5, "<html><p>moved</p></html>").otherwise("")
    )
    path = fresh_path(m.spark, "folder")
    rows = m.table("supplier").select(k.alias("kind"), name.alias("symbol"), doc.alias("doc"))
    # a file each: however few the bytes, their number asks for many tasks, and a given number is not merged
    tasks = int(m.spark.conf.get("spark.sql.shuffle.partitions"))
    rows.repartition(tasks, "kind", "symbol").write.partitionBy("kind", "symbol").text(path)
    out = docs.batch_outcomes(docs.read_documents(m.spark, path))
    error = F.when((F.col("format") == "xml") & F.col("error").isNotNull(), "bad").otherwise(F.col("error"))
    return out.select(F.regexp_extract("doc_id", "symbol=([^/]+)/", 1).alias("symbol"), "format", "records", error.alias("error"))
