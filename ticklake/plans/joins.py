"""JOIN: equi, as-of, point-in-time, anti and self joins."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ticklake.bridge import with_sql
from ticklake.functions.finance import pe_ratio
from ticklake.functions.rounding import r2, r4, sql2, sql4
from ticklake.operators import versions
from ticklake.operators.adjust import adjust_prices, cumulative_factors
from ticklake.operators.asof import SPREAD_ROWS, asof_join, by_month
from ticklake.operators.calendar import alignment, build_calendar, with_trading_days
from ticklake.operators.dedupe import prefer_first_source
from ticklake.plans.registry import query
from ticklake.session import dealt
from ticklake.sources.instruments import enrich_instruments, unique_instruments

CUM = """, f AS (SELECT symbol, ex_date, product(adjustment_factor) OVER (PARTITION BY symbol ORDER BY ex_date DESC,
 action_type ROWS UNBOUNDED PRECEDING) AS cum FROM ca)"""


def calendar_of(m):
    span = m.table("orders").agg(F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("last"))
    return build_calendar(span, m.holidays)


@query(
    "join01_prices_with_factors",
    with_sql("ohlc", "ca", body="""SELECT o.symbol, trade_date, ex_date, action_type, adjustment_factor FROM ohlc o
 LEFT JOIN ca ON o.symbol = ca.symbol AND year(ex_date) = year(trade_date)"""),
)
def _(m):
    bars = m.trades.select("symbol", "trade_date").distinct().withColumn("y", F.year("trade_date"))
    return bars.join(m.ca.withColumn("y", F.year("ex_date")), ["symbol", "y"], "left").select(
        "symbol", "trade_date", "ex_date", "action_type", "adjustment_factor"
    )


@query(
    "join02_join_back_on_symbol_date",
    with_sql("ohlc", "ca", body=f"""SELECT o.symbol, trade_date, {sql4("close")} AS close, action_type
 FROM ohlc o LEFT JOIN ca ON o.symbol = ca.symbol AND ex_date = trade_date"""),
)
def _(m):
    events = m.ca.select("symbol", F.col("ex_date").alias("trade_date"), "action_type")
    return m.closes.join(events, ["symbol", "trade_date"], "left").withColumn("close", r4("close"))


@query(
    "join03_asof_forward",
    with_sql("ohlc", "ca", body=f"""{CUM} SELECT o.symbol, o.trade_date, f.ex_date AS next_ex_date, {sql4("cum")} AS factor
 FROM ohlc o ASOF LEFT JOIN f ON o.symbol = f.symbol AND o.trade_date <= f.ex_date"""),
)
def _(m):
    f = cumulative_factors(m.ca).select(
        "symbol", "ex_date", F.col("ex_date").alias("next_ex_date"), F.col("cumulative_factor").alias("factor")
    )
    bars = m.trades.select("symbol", "trade_date").distinct()
    out = asof_join(bars, f, ["symbol"], "trade_date", "ex_date", ["next_ex_date", "factor"], "forward")
    return out.withColumn("factor", r4("factor"))


@query(
    "join04_asof_nearest",
    with_sql("financials", "ohlc", body=f""", b AS (SELECT f.symbol, f.period_end_date, f.eps, o.trade_date AS bd, o.close AS bc FROM financials f
 ASOF LEFT JOIN ohlc o ON f.symbol = o.symbol AND f.period_end_date >= o.trade_date),
 n AS (SELECT b.*, o.trade_date AS nd, o.close AS nc FROM b ASOF LEFT JOIN ohlc o ON b.symbol = o.symbol
   AND b.period_end_date <= o.trade_date),
 p AS (SELECT symbol, period_end_date, eps, CASE WHEN nd IS NULL OR (bd IS NOT NULL AND period_end_date - bd <= nd - period_end_date) THEN bd ELSE nd END AS trade_date,
   CASE WHEN nd IS NULL OR (bd IS NOT NULL AND period_end_date - bd <= nd - period_end_date) THEN bc ELSE nc END AS close FROM n)
 SELECT symbol, period_end_date, trade_date, CASE WHEN eps > 0 THEN {sql4("close / eps")} END AS pe FROM p"""),
)
def _(m):
    bars = m.closes.withColumn("at", F.col("trade_date"))
    out = asof_join(
        m.financials.select("symbol", "period_end_date", "eps"), bars, ["symbol"], "period_end_date", "at",
        ["trade_date", "close"], "nearest",
    )
    return out.select("symbol", "period_end_date", "trade_date", r4(pe_ratio(F.col("close"), F.col("eps"))).alias("pe"))


@query(
    "join05_asof_backward_pe",
    with_sql("financials", "ohlc", body=f"""SELECT f.symbol, period_end_date, eps, {sql4("close")} AS market_price, trade_date,
 {sql4("close / eps")} AS pe_ratio FROM financials f ASOF LEFT JOIN ohlc o ON f.symbol = o.symbol AND f.period_end_date >= o.trade_date
 WHERE eps > 0 AND close IS NOT NULL"""),
)
def _(m):
    out = asof_join(
        m.financials.filter("eps > 0").select("symbol", "period_end_date", "eps"),
        m.closes.withColumn("at", F.col("trade_date")), ["symbol"], "period_end_date", "at", ["trade_date", "close"],
    ).filter(F.col("close").isNotNull())
    return out.select(
        "symbol", "period_end_date", "eps", r4("close").alias("market_price"), "trade_date",
        r4(pe_ratio(F.col("close"), F.col("eps"))).alias("pe_ratio"),
    )


@query(
    "join06_asof_tolerance",
    with_sql("deals", "ohlc", body=f""", j AS (SELECT d.deal_no, d.deal_line, d.symbol, d.deal_date, d.value, o.trade_date, o.close FROM deals d ASOF LEFT JOIN ohlc o
 ON d.symbol = o.symbol AND d.deal_date > o.trade_date)
 SELECT deal_no, deal_line, symbol, deal_date, value, CASE WHEN deal_date - trade_date <= 5 THEN trade_date END AS quote_date,
 CASE WHEN deal_date - trade_date <= 5 THEN {sql4("close")} END AS quote FROM j"""),
)
def _(m):
    bars = m.closes.select("symbol", "trade_date", F.col("trade_date").alias("quote_date"), F.col("close").alias("quote"))
    out = asof_join(
        m.deals.select("deal_no", "deal_line", "symbol", "deal_date", "value"), bars, ["symbol"], "deal_date",
        "trade_date", ["quote_date", "quote"], allow_exact=False, tolerance_days=5, spread=SPREAD_ROWS,
    )
    return out.withColumn("quote", r4("quote"))


@query(
    "join06_asof_long_series",
    with_sql("ticks", body=f""", c AS (SELECT entity, ts, price FROM ticks WHERE kind = 'click'),
 b AS (SELECT event_id, entity, ts FROM ticks WHERE kind <> 'click')
 SELECT event_id, b.entity, {sql4("price")} AS last_click FROM b ASOF LEFT JOIN c ON b.entity = c.entity AND b.ts >= c.ts"""),
)
def _(m):
    clicks = m.ticks.filter("kind = 'click'").select("entity", F.col("ts").alias("at"), F.col("price").alias("last_click"))
    others = m.ticks.filter("kind <> 'click'").select("event_id", "entity", "ts")
    # a limit this low cuts the busy users of the smallest tables as well
    out = asof_join(others, clicks, ["entity"], "ts", "at", ["last_click"], spread=100)
    return out.select("event_id", "entity", r4("last_click").alias("last_click"))


@query(
    "join07_macro_asof_market",
    with_sql("macro", "ohlc", body=f""", mkt AS (SELECT trade_date, sum(turnover) AS turnover FROM ohlc GROUP BY 1)
 SELECT indicator_code, indicator_date, value, trade_date AS market_date, {sql2("turnover")} AS total_turnover
 FROM macro m ASOF LEFT JOIN mkt ON m.indicator_date >= mkt.trade_date"""),
)
def _(m):
    mkt = m.trades.groupBy("trade_date").agg(r2(F.sum("amount")).alias("total_turnover")).withColumn(
        "market_date", F.col("trade_date")
    )
    return asof_join(
        m.macro, mkt, [], "indicator_date", "trade_date", ["market_date", "total_turnover"], bucket=by_month
    )


INSTR = """, px AS (SELECT symbol, isin, min(company_name) AS company_name, source, count(*) AS n FROM listings GROUP BY ALL),
 mst AS (SELECT DISTINCT symbol, CASE WHEN volume % 4 = 0 THEN 'ZZ' || isin ELSE isin END AS isin, company_name AS master_name, grp AS series FROM listings WHERE source = 'B')"""


def _master(m):
    changed = F.when(F.col("volume") % 4 == 0, F.concat(F.lit("ZZ"), F.col("isin"))).otherwise(F.col("isin"))
    return m.listings.filter("source = 'B'").select(
        "symbol", changed.alias("isin"), F.col("company_name").alias("master_name"), F.col("grp").alias("series")
    ).distinct()


@query(
    "join08_master_enrichment",
    with_sql("listings", body=f"""{INSTR}, exact AS (SELECT px.symbol, px.isin, px.source, mst.master_name, mst.series FROM px
   LEFT JOIN mst ON px.symbol = mst.symbol AND px.isin = mst.isin),
 got AS (SELECT * FROM exact WHERE master_name IS NOT NULL),
 retry AS (SELECT e.symbol, e.isin, e.source, mst.master_name, mst.series FROM exact e LEFT JOIN mst ON e.symbol = mst.symbol
   WHERE e.master_name IS NULL)
 SELECT symbol, isin, source, master_name, series, symbol || ':' || source || ':NSE' AS instrument_id FROM got UNION ALL
 SELECT symbol, isin, source, master_name, series, symbol || ':' || source || ':NSE' FROM retry"""),
)
def _(m):
    px = m.listings.select("symbol", "isin", "source").distinct()
    out = enrich_instruments(px, _master(m), ["master_name", "series"])
    return out.withColumn("instrument_id", F.concat_ws(":", "symbol", "source", F.lit("NSE")))


@query(
    "join09_unique_instruments",
    with_sql("listings", body="""SELECT symbol, isin, source, min(company_name) AS company_name FROM listings
 WHERE symbol IS NOT NULL AND symbol <> '' GROUP BY ALL"""),
)
def _(m):
    return unique_instruments(m.listings, ["symbol", "isin", "source"], "company_name")


@query(
    "join10_prices_with_master",
    with_sql("listings", body=f""", mst AS (SELECT DISTINCT symbol || ':' || source || ':NSE' AS instrument_id, company_name, grp AS series FROM listings WHERE source = 'A')
 SELECT l.symbol, l.source, {sql4("l.close")} AS close, mst.company_name, mst.series FROM listings l LEFT JOIN mst
 ON l.symbol = split_part(mst.instrument_id, ':', 1) AND l.source = split_part(mst.instrument_id, ':', 2)"""),
)
def _(m):
    master = m.listings.filter("source = 'A'").select(
        F.concat_ws(":", "symbol", "source", F.lit("NSE")).alias("instrument_id"), "company_name", F.col("grp").alias("series")
    ).distinct()
    parts = F.split("instrument_id", ":")
    keyed = master.select(parts[0].alias("symbol"), parts[1].alias("source"), "company_name", "series")
    return m.listings.select("symbol", "source", r4("close").alias("close")).join(keyed, ["symbol", "source"], "left")


SCD = """, ch AS (SELECT symbol, as_of, status, lag(status) OVER (PARTITION BY symbol ORDER BY as_of) AS p FROM master_changes),
 v AS (SELECT symbol, status, as_of AS valid_from, lead(as_of) OVER (PARTITION BY symbol ORDER BY as_of) AS valid_to
   FROM ch WHERE p IS NULL OR p <> status)"""


@query(
    "join11_point_in_time",
    with_sql("master_changes", body=f"""{SCD} SELECT o_orderkey, 'C' || o_custkey AS symbol, CAST(o_orderdate AS DATE) + 10 AS on_date, v.status, v.valid_from
 FROM orders LEFT JOIN v ON v.symbol = 'C' || o_custkey AND v.valid_from <= CAST(o_orderdate AS DATE) + 10
 AND (v.valid_to IS NULL OR CAST(o_orderdate AS DATE) + 10 < v.valid_to)"""),
)
def _(m):
    v = versions.scd2_build(m.master_changes, "symbol", "as_of", ["status"]).withColumn("from_copy", F.col("valid_from"))
    facts = m.table("orders").select(
        "o_orderkey", F.concat(F.lit("C"), F.col("o_custkey")).alias("symbol"),
        F.date_add(F.to_date("o_orderdate"), 10).alias("on_date"),
    )
    out = versions.point_in_time(facts, v, "symbol", "on_date", ["status", "from_copy"], bucket=by_month)
    return out.withColumnRenamed("from_copy", "valid_from")


@query(
    "join12_scd2_build",
    with_sql("master_changes", body=f"{SCD} SELECT symbol, status, valid_from, valid_to, valid_to IS NULL AS is_current FROM v"),
)
def _(m):
    return versions.scd2_build(m.master_changes, "symbol", "as_of", ["status"])


@query(
    "join12_scd2_merge",
    with_sql("master_changes", body=f"""{SCD}, b AS (SELECT symbol, arg_max(status, as_of) AS status FROM master_changes
   WHERE as_of >= DATE '1999-01-01' GROUP BY 1),
 h AS (SELECT symbol, status, as_of AS valid_from, lead(as_of) OVER (PARTITION BY symbol ORDER BY as_of) AS valid_to FROM
   (SELECT *, lag(status) OVER (PARTITION BY symbol ORDER BY as_of) AS p FROM master_changes WHERE as_of < DATE '1999-01-01') WHERE p IS NULL OR p <> status),
 r AS (SELECT h.symbol, h.status, h.valid_from, CASE WHEN h.valid_to IS NULL AND b.status IS NOT NULL AND b.status <> h.status
     THEN DATE '2002-01-01' ELSE h.valid_to END AS valid_to FROM h LEFT JOIN b ON h.symbol = b.symbol
   UNION ALL SELECT b.symbol, b.status, DATE '2002-01-01', NULL FROM b LEFT JOIN (SELECT * FROM h WHERE valid_to IS NULL) o ON b.symbol = o.symbol
     WHERE o.symbol IS NULL OR o.status <> b.status)
 SELECT *, valid_to IS NULL AS is_current FROM r"""),
)
def _(m):
    old = m.master_changes.filter("as_of < DATE'1999-01-01'")
    history = versions.scd2_build(old, "symbol", "as_of", ["status"])
    batch = (
        m.master_changes.filter("as_of >= DATE'1999-01-01'")
        .groupBy("symbol").agg(F.max_by("status", "as_of").alias("status"))
    )
    return versions.scd2_merge(history, batch, "symbol", F.lit("2002-01-01").cast("date"), ["status"])


@query(
    "join12_scd2_late_merge",
    with_sql("master_changes", body="""
 , ev AS (SELECT symbol, as_of, status, row_number() OVER (PARTITION BY symbol ORDER BY as_of) AS k FROM (SELECT *, lag(status) OVER (PARTITION BY symbol ORDER BY as_of) AS p FROM master_changes) WHERE p IS NULL OR p <> status),
 h AS (SELECT symbol, status, as_of FROM (SELECT *, lag(status) OVER (PARTITION BY symbol ORDER BY as_of) AS p FROM ev WHERE k % 3 <> 2) WHERE p IS NULL OR p <> status),
 late AS (SELECT symbol, status, as_of FROM ev WHERE k % 3 = 2 UNION ALL SELECT symbol, 'X' AS status, min(as_of) - 30 FROM ev GROUP BY 1),
 a AS (SELECT *, lag(status) OVER (PARTITION BY symbol ORDER BY as_of) AS p FROM (SELECT * FROM h UNION ALL SELECT * FROM late)),
 v AS (SELECT symbol, status, as_of AS valid_from, lead(as_of) OVER (PARTITION BY symbol ORDER BY as_of) AS valid_to FROM a WHERE p IS NULL OR p <> status)
 SELECT *, valid_to IS NULL AS is_current FROM v"""),
)
def _(m):
    """Every third change of a symbol, and one before its first, arrive after all others: the history equals a rebuild."""
    w = Window.partitionBy("symbol").orderBy("as_of")
    before = F.lag("status").over(w)
    changes = dealt(m.master_changes, "symbol").withColumn("p", before).filter("p IS NULL OR p <> status").withColumn("k", F.row_number().over(w)).drop("p")
    first = changes.groupBy("symbol").agg(F.date_sub(F.min("as_of"), 30).alias("as_of")).withColumn("status", F.lit("X"))
    history = versions.scd2_build(changes.filter("k % 3 <> 2"), "symbol", "as_of", ["status"])
    late = changes.filter("k % 3 = 2").select("symbol", "as_of", "status").unionByName(first)
    return versions.scd2_merge(history, late, "symbol", F.col("as_of"), ["status"])


@query(
    "join13_yoy",
    with_sql("financials", body=f"""SELECT c.symbol, c.period_end_date AS current_period, c.revenue AS current_revenue, p.revenue AS previous_revenue,
 {sql4("(c.revenue - p.revenue) / p.revenue * 100")} AS yoy_pct FROM financials c JOIN financials p ON c.symbol = p.symbol
 AND c.quarter = p.quarter AND c.year = p.year + 1 WHERE p.revenue > 0"""),
)
def _(m):
    f = m.financials
    prev = f.select("symbol", "quarter", (F.col("year") + 1).alias("year"), F.col("revenue").alias("previous_revenue")).filter(
        "previous_revenue > 0"
    )
    return f.join(prev, ["symbol", "quarter", "year"]).select(
        "symbol", F.col("period_end_date").alias("current_period"), F.col("revenue").alias("current_revenue"), "previous_revenue",
        r4((F.col("revenue") - F.col("previous_revenue")) / F.col("previous_revenue") * 100).alias("yoy_pct"),
    )


@query(
    "join14_qoq",
    with_sql("shareholding", body=f"""SELECT c.symbol, c.quarter_end_date, c.institutional AS current_institutional,
 p.institutional AS previous_institutional, {sql4("c.institutional - p.institutional")} AS change FROM shareholding c JOIN shareholding p
 ON c.symbol = p.symbol AND c.year = p.year AND c.quarter = p.quarter + 1"""),
)
def _(m):
    s = m.shareholding
    prev = s.select("symbol", "year", (F.col("quarter") + 1).alias("quarter"), F.col("institutional").alias("previous_institutional"))
    return s.join(prev, ["symbol", "year", "quarter"]).select(
        "symbol", "quarter_end_date", F.col("institutional").alias("current_institutional"), "previous_institutional",
        r4(F.col("institutional") - F.col("previous_institutional")).alias("change"),
    )


@query(
    "join14_qoq_across_years",
    with_sql("shareholding", body=f"""SELECT symbol, quarter_end_date, {sql4("institutional - p")} AS change FROM (SELECT *,
 lag(institutional) OVER w AS p, lag(year * 4 + quarter) OVER w AS pq FROM shareholding WINDOW w AS (PARTITION BY symbol ORDER BY quarter_end_date))
 WHERE pq = year * 4 + quarter - 1"""),
)
def _(m):
    w = Window.partitionBy("symbol").orderBy("quarter_end_date")
    n = F.col("year") * 4 + F.col("quarter")
    return (
        m.shareholding.withColumns({"p": F.lag("institutional").over(w), "pq": F.lag(n).over(w)})
        .filter(F.col("pq") == n - 1)
        .select("symbol", "quarter_end_date", r4(F.col("institutional") - F.col("p")).alias("change"))
    )


@query(
    "join15_index_overlap",
    with_sql("constituents", body="""SELECT a.symbol, a.company_name, a.partkey AS first_part, b.partkey AS second_part, a.weight AS first_weight, b.weight AS second_weight FROM
 (SELECT * FROM constituents WHERE index_name = 'Brand#2' AND action = 'ADD') a JOIN
 (SELECT * FROM constituents WHERE index_name = 'Brand#17' AND action = 'ADD') b ON a.symbol = b.symbol"""),
)
def _(m):
    added = m.constituents.filter("action = 'ADD'")
    a = added.filter("index_name = 'Brand#2'").select(
        "symbol", "company_name", F.col("partkey").alias("first_part"), F.col("weight").alias("first_weight")
    )
    b = added.filter("index_name = 'Brand#17'").select(
        "symbol", F.col("partkey").alias("second_part"), F.col("weight").alias("second_weight")
    )
    return a.join(b, "symbol")


@query(
    "join16_deals_vs_prices",
    with_sql("deals", "ohlc", body=f"""SELECT d.deal_no, d.deal_line, d.deal_date, d.symbol, {sql4("avg_price")} AS deal_price, quantity, {sql4("close")} AS close,
 {sql4("(avg_price - close) / close * 100")} AS price_deviation_pct FROM deals d LEFT JOIN ohlc o ON d.symbol = o.symbol AND d.deal_date = o.trade_date"""),
)
def _(m):
    bars = m.closes.withColumnRenamed("trade_date", "deal_date")
    return m.deals.join(bars, ["symbol", "deal_date"], "left").select(
        "deal_no", "deal_line", "deal_date", "symbol", r4("avg_price").alias("deal_price"), "quantity", r4("close").alias("close"),
        r4(F.try_divide(F.col("avg_price") - F.col("close"), F.col("close")) * 100).alias("price_deviation_pct"),
    )


@query(
    "join17_outlier_deals",
    with_sql("deals", body=f""", st AS (SELECT symbol, deal_type, avg(avg_price) AS a, stddev_pop(avg_price) AS s FROM deals GROUP BY ALL)
 SELECT deal_no, deal_line, deal_date, d.symbol, client_name, d.deal_type, {sql4("avg_price")} AS avg_price, {sql4("(avg_price - a) / s")} AS z_score FROM deals d JOIN st
 ON d.symbol = st.symbol AND d.deal_type = st.deal_type WHERE s > 0 AND abs((avg_price - a) / s) > 3"""),
)
def _(m):
    from ticklake.operators.stats import outliers

    return outliers(m.deals, ["symbol", "deal_type"], "avg_price", 3.0).select(
        "deal_no", "deal_line", "deal_date", "symbol", "client_name", "deal_type", r4("avg_price").alias("avg_price"), r4("z_score").alias("z_score")
    )


@query(
    "join18_macro_vs_price_month",
    with_sql("macro", "ohlc", body=f""", px AS (SELECT CAST(date_trunc('month', trade_date) AS DATE) AS mth, avg(close) AS c FROM ohlc GROUP BY 1),
 j AS (SELECT indicator_code, mth, value, c, lag(c) OVER w AS pc, lag(value) OVER w AS pv FROM macro JOIN px ON indicator_date = mth
   WINDOW w AS (PARTITION BY indicator_code ORDER BY mth))
 SELECT indicator_code, mth AS "month", value, {sql4("c")} AS avg_close, {sql4("(c - pc) / pc * 100")} AS price_change_pct, {sql2("value - pv")} AS value_change FROM j"""),
)
def _(m):
    px = m.closes.groupBy(F.trunc("trade_date", "MM").alias("month")).agg(F.avg("close").alias("c"))
    w = Window.partitionBy("indicator_code").orderBy("month")
    j = m.macro.withColumnRenamed("indicator_date", "month").join(px, "month")
    pc, pv = F.lag("c").over(w), F.lag("value").over(w)
    return j.select(
        "indicator_code", "month", "value", r4("c").alias("avg_close"), r4(F.try_divide(F.col("c") - pc, pc) * 100).alias("price_change_pct"),
        r2(F.col("value") - pv).alias("value_change"),
    )


@query(
    "join19_company_profile",
    with_sql("financials", "shareholding", "ohlc", body=f""", b AS (SELECT f.*, s.promoter, s.fii, s.pledged FROM financials f LEFT JOIN shareholding s
   ON f.symbol = s.symbol AND f.period_end_date = s.quarter_end_date WHERE f.eps > 0)
 SELECT b.symbol, period_end_date, revenue, net_profit, eps, promoter, fii, pledged, {sql4("close")} AS latest_price, {sql4("close / eps")} AS pe_ratio
 FROM b ASOF LEFT JOIN ohlc o ON b.symbol = o.symbol AND b.period_end_date >= o.trade_date"""),
)
def _(m):
    s = m.shareholding.select("symbol", F.col("quarter_end_date").alias("period_end_date"), "promoter", "fii", "pledged")
    base = m.financials.filter("eps > 0").select("symbol", "period_end_date", "revenue", "net_profit", "eps")
    base = base.join(s, ["symbol", "period_end_date"], "left")
    out = asof_join(base, m.closes, ["symbol"], "period_end_date", "trade_date", ["close"])
    return out.select(
        *base.columns, r4("close").alias("latest_price"), r4(pe_ratio(F.col("close"), F.col("eps"))).alias("pe_ratio")
    )


@query(
    "join20_raw_vs_adjusted",
    with_sql("ohlc", "ca", body=f"""{CUM}, adj AS (SELECT o.symbol, o.trade_date, close / coalesce(cum, 1) AS adj_close FROM ohlc o ASOF LEFT JOIN f
   ON o.symbol = f.symbol AND o.trade_date < f.ex_date)
 SELECT o.symbol, o.trade_date, {sql4("o.close")} AS raw_close, {sql4("adj_close")} AS adj_close, {sql4("o.close / adj_close")} AS ratio
 FROM ohlc o JOIN adj USING (symbol, trade_date)"""),
)
def _(m):
    # the raw close travels beside the one that is adjusted
    adjusted = adjust_prices(m.closes.withColumn("raw_close", F.col("close")), cumulative_factors(m.ca))
    return adjusted.select(
        "symbol", "trade_date", r4("raw_close").alias("raw_close"), r4("close").alias("adj_close"), r4(F.col("raw_close") / F.col("close")).alias("ratio")
    )


@query(
    "join21_only_on_second_exchange",
    with_sql("listings", body=f"""SELECT isin, symbol, {sql4("close")} AS close, volume FROM listings b WHERE source = 'B' AND NOT EXISTS
 (SELECT 1 FROM listings a WHERE a.source = 'A' AND a.isin = b.isin)"""),
)
def _(m):
    a = m.listings.filter("source = 'A'").select("isin").distinct()
    b = m.listings.filter("source = 'B'")
    return b.join(a, "isin", "left_anti").select("isin", "symbol", r4("close").alias("close"), "volume")


@query(
    "join22_missing_dates",
    with_sql("calendar", "deals", body="""SELECT trade_date, t.deal_type, 'Missing deals data' AS status FROM calendar c, (VALUES ('BULK'), ('BLOCK')) t(deal_type) WHERE is_trading_day
 AND NOT EXISTS (SELECT 1 FROM deals d WHERE d.deal_date = c.trade_date AND d.deal_type = t.deal_type)"""),
)
def _(m):
    """Per deal type the trading days without deals."""
    days = calendar_of(m).filter("is_trading_day").select("trade_date", F.explode(F.array(F.lit("BULK"), F.lit("BLOCK"))).alias("deal_type"))
    have = m.deals.select(F.col("deal_date").alias("trade_date"), "deal_type").distinct()
    return days.join(have, ["trade_date", "deal_type"], "left_anti").withColumn("status", F.lit("Missing deals data"))


@query(
    "join23_overlap_count",
    with_sql("listings", body="""SELECT count(*) AS overlapping FROM (SELECT DISTINCT isin FROM listings WHERE source = 'A' AND isin IS NOT NULL) a
 JOIN (SELECT DISTINCT isin FROM listings WHERE source = 'B' AND isin IS NOT NULL) b USING (isin)"""),
)
def _(m):
    a = m.listings.filter("source = 'A' AND isin IS NOT NULL").select("isin").distinct()
    b = m.listings.filter("source = 'B' AND isin IS NOT NULL").select("isin")
    return a.join(b, "isin", "left_semi").agg(F.count("*").alias("overlapping"))


@query(
    "join24_feature_lineage",
    with_sql("ohlc", body=f"""SELECT symbol, trade_date, {sql4("avg(close) OVER (PARTITION BY symbol ORDER BY trade_date ROWS 4 PRECEDING)")} AS sma_5,
 volume, turnover FROM ohlc"""),
)
def _(m):
    from ticklake.operators.indicators import sma

    feats = sma(m.closes, windows=(5,), partial=True).select("symbol", "trade_date", r4("sma_5").alias("sma_5"))
    return feats.join(m.ohlc.select("symbol", "trade_date", "volume", "turnover"), ["symbol", "trade_date"], "left")


@query(
    "join25_calendar_alignment",
    with_sql("ohlc", "calendar", body="""SELECT symbol, o.trade_date, coalesce(is_trading_day, isodow(o.trade_date) < 6) AS is_trading_day,
 (SELECT min(t.trade_date) FROM calendar t WHERE t.is_trading_day AND t.trade_date > o.trade_date AND t.trade_date - o.trade_date <= 60) AS next_trading_day,
 (SELECT max(t.trade_date) FROM calendar t WHERE t.is_trading_day AND t.trade_date < o.trade_date AND o.trade_date - t.trade_date <= 60) AS previous_trading_day
 FROM ohlc o LEFT JOIN calendar c ON o.trade_date = c.trade_date"""),
)
def _(m):
    bars = m.trades.select("symbol", "trade_date").distinct()
    return with_trading_days(bars, "trade_date", calendar_of(m)).select("symbol", "trade_date", "is_trading_day", "next_trading_day", "previous_trading_day")


@query(
    "set04_cross_exchange_dedupe",
    with_sql("listings", body=f"""SELECT isin, symbol, {sql4("close")} AS close, source FROM listings x WHERE source = 'A' OR NOT EXISTS
 (SELECT 1 FROM listings a WHERE a.source = 'A' AND a.isin = x.isin)"""),
)
def _(m):
    rows = m.listings.select("isin", "symbol", r4("close").alias("close"), "source")
    return prefer_first_source(rows.filter("source = 'A'"), rows.filter("source = 'B'"), "isin")


@query(
    "time05_calendar_issues",
    with_sql("ohlc", "calendar", body=""", span AS (SELECT symbol, min(trade_date) AS a, max(trade_date) AS b FROM ohlc GROUP BY 1),
 d AS (SELECT symbol, CAST(unnest(generate_series(a::TIMESTAMP, b::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS trade_date FROM span),
 e AS (SELECT d.symbol, d.trade_date, coalesce(c.is_trading_day, isodow(d.trade_date) < 6) AS f FROM d LEFT JOIN calendar c USING (trade_date))
 SELECT e.symbol, e.trade_date, CASE WHEN f THEN 'MISSING' ELSE 'UNEXPECTED' END AS issue FROM e LEFT JOIN ohlc o
 ON e.symbol = o.symbol AND e.trade_date = o.trade_date WHERE f = (o.symbol IS NULL)"""),
)
def _(m):
    return alignment(m.trades.select("symbol", "trade_date"), "symbol", calendar_of(m))
