"""Market relations derived from the given tables, as Spark plans and as SQL.

Every registered query works on these relations, so its work grows with the given tables.
``Market`` holds the Spark side; ``SQL`` the same derivations for the comparison engine.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.session import dealt, stored
from ticklake.sources.lake import read_table


#: columns of bars with planted defects, in text both engines read; ``tag`` picks the defect
DIRTY_COLUMNS = {
    "event_id": "concat(symbol, ':', CAST(trade_date AS VARCHAR(10)))",
    "event_time": "CASE WHEN tag = 8 THEN TIMESTAMP '2099-01-01 00:00:00' ELSE CAST(trade_date AS TIMESTAMP) END",
    "ingest_time": "CAST(trade_date AS TIMESTAMP) + CASE WHEN tag = 7 THEN INTERVAL '72' HOUR ELSE INTERVAL '18' HOUR END",
    "source": "'feed'",
    "schema_version": "CASE WHEN tag = 15 THEN '1' ELSE 'v1' END",
    "entity_id": "concat(symbol, ':NSE')",
    "instrument_id": "concat(symbol, ':NSE')",
    "symbol": "CASE WHEN tag = 13 THEN '' ELSE symbol END",
    "exchange": "CASE WHEN tag = 14 THEN 'XXX' ELSE 'NSE' END",
    "isin": "CASE WHEN tag = 16 THEN 'bad' WHEN tag = 18 THEN NULL ELSE concat('INE', lpad(CAST(suppkey AS VARCHAR(20)), 8, '0'), '1') END",
    "trade_date": "CASE WHEN tag = 12 THEN DATE '1985-01-01' ELSE trade_date END",
    "prev_close": "CASE WHEN tag = 5 THEN close * CAST(0.5 AS DOUBLE) ELSE close END",
    "open": "CASE WHEN tag = 2 THEN low * CAST(0.5 AS DOUBLE) ELSE open END",
    "high": "CASE WHEN tag = 0 THEN low - 1 ELSE high END",
    "low": "CASE WHEN tag = 10 THEN CAST(-1 AS DOUBLE) ELSE low END",
    "close": "CASE WHEN tag = 1 THEN close * 3 WHEN tag = 9 THEN NULL ELSE close END",
    "volume": "CASE WHEN tag = 3 THEN CAST(0 AS BIGINT) WHEN tag = 11 THEN CAST(-5 AS BIGINT) ELSE volume END",
    "turnover": "CASE WHEN tag = 4 THEN turnover * 2 ELSE turnover END",
    "trades": "trades",
    "adjustment_factor": "CASE WHEN tag = 6 THEN CAST(-1 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END",
    "adjustment_date": "CASE WHEN tag = 6 THEN trade_date END",
    "is_trading_day": "TRUE",
}
DIRTY_TAG = "(suppkey * 7 + dayofyear(trade_date)) % 60"


def symbol_of(key: str) -> Column:
    return F.concat(F.lit("S"), F.col(key)).alias("symbol")


def packed_order() -> Column:
    """(order, line, part, price, quantity) as one number that sorts the same way."""

    def shifted(c: str, zeros: int) -> Column:
        return F.col(c).cast("decimal(38,0)") * F.lit("1" + "0" * zeros).cast("decimal(38,0)")

    price_and_quantity = F.round(F.col("l_extendedprice") * 100).cast("bigint") * 100 + F.col("l_quantity").cast("bigint")
    whole = shifted("l_orderkey", 22) + shifted("l_linenumber", 21) + shifted("l_partkey", 10) + price_and_quantity
    return whole.cast("decimal(38,0)")


class Market:
    """Lazy market relations over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, days: tuple[str, str] | None = None, suppkeys: tuple[int, ...] = ()):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")
        self.days = days
        self.suppkeys = suppkeys

    def sliced(self, first: str, last: str, suppkeys: tuple[int, ...] = ()) -> Market:
        """The same relations over a date range (and symbols), filtered on the stored columns so that
        the filter reaches the Parquet scan."""
        return Market(self.spark, self.dir, (first, last), suppkeys)

    def with_stored_bars(self) -> Market:
        """The same relations over bars that are built and stored once, for a query whose jobs read them several times."""
        market = Market(self.spark, self.dir, self.days, self.suppkeys)
        market.ohlc = stored(self.ohlc, "built-bars")
        return market

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.dir}/{name}.parquet")

    @cached_property
    def trades(self) -> DataFrame:
        """One row per trade; ``k`` totally orders the trades of a day.

        It packs order, line, part, price and quantity into one decimal: being of fixed width it lets
        first and last price be hash aggregates, where a struct would force a sort of all trades.
        """
        rows = self.table("lineitem")
        if self.days is not None:
            first, last = (F.lit(d).cast("timestamp_ntz") for d in self.days)
            rows = rows.filter((F.col("l_shipdate") >= first) & (F.col("l_shipdate") < last + F.expr("INTERVAL 1 DAY")))
        if self.suppkeys:
            rows = rows.filter(F.col("l_suppkey").isin(*self.suppkeys))
        return rows.select(
            symbol_of("l_suppkey"),
            F.col("l_suppkey").alias("suppkey"),
            F.to_date("l_shipdate").alias("trade_date"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("px"),
            packed_order().alias("k"),
            F.col("l_quantity").alias("qty"),
            F.col("l_extendedprice").alias("amount"),
        )

    @cached_property
    def ohlc(self) -> DataFrame:
        """Daily bars, unique per (symbol, trade_date); a busy symbol collapses map-side."""
        bars = self.trades.groupBy("suppkey", "trade_date").agg(
            F.min_by("px", "k").alias("open"),
            F.max("px").alias("high"),
            F.min("px").alias("low"),
            F.max_by("px", "k").alias("close"),
            F.sum("qty").cast("bigint").alias("volume"),
            F.round(F.sum("amount"), 2).alias("turnover"),
            F.count("*").alias("trades"),
        )
        return bars.select(symbol_of("suppkey"), *bars.columns)

    @cached_property
    def closes(self) -> DataFrame:
        """Only what close-based indicators read."""
        bars = self.trades.groupBy("suppkey", "trade_date").agg(F.max_by("px", "k").alias("close"))
        return bars.select(symbol_of("suppkey"), "trade_date", "close")

    @cached_property
    def dirty(self) -> DataFrame:
        """Bars with one planted defect per tag, and second copies of some rows."""
        tagged = self.ohlc.withColumn("tag", F.expr(DIRTY_TAG))
        # copies are made row by row, as a union would build the bars a second time
        tagged = tagged.withColumn("copy", F.explode(F.when(F.col("tag") == 17, F.array(F.lit(""), F.lit("#2"))).otherwise(F.array(F.lit("")))))
        rows = tagged.select(*[F.expr(e).alias(c) for c, e in DIRTY_COLUMNS.items()], "copy")
        return rows.withColumn("event_id", F.concat("event_id", "copy")).drop("copy")

    @cached_property
    def ca(self) -> DataFrame:
        """Corporate actions: the first trading day of each symbol and year."""
        n = F.pmod(F.col("suppkey") + F.col("y"), F.lit(4))
        return (
            self.trades.groupBy("symbol", "suppkey", F.year("trade_date").alias("y"))
            .agg(F.min("trade_date").alias("ex_date"))
            .select(
                "symbol",
                "ex_date",
                F.when(n == 0, "SPLIT").when(n == 1, "BONUS").when(n == 2, "DIVIDEND").otherwise("OTHER").alias(
                    "action_type"
                ),
                F.when(n == 0, 2.0).when(n == 1, 1.5).when(n == 2, 0.98).otherwise(1.0).alias("adjustment_factor"),
                F.when(n == 2, F.col("suppkey") % 20 + 1.0).alias("dividend_amount"),
            )
        )

    @cached_property
    def ca_text(self) -> DataFrame:
        """Corporate actions with free-text purpose lines."""
        n = F.pmod(F.col("suppkey") + F.col("y"), F.lit(13))
        a = F.pmod(F.col("suppkey"), F.lit(4)) + 1
        texts = [
            F.concat(F.lit("Face Value Split From Rs 10/- To Rs "), a, F.lit("/- Per Share")),
            F.concat(F.lit("Sub-Division from Rs. 100/- to Rs. "), a * 10, F.lit("/-")),
            F.concat(F.lit("Bonus issue "), a, F.lit(":2")),
            F.concat(F.lit("Capitalisation "), a, F.lit(" for 3")),
            F.concat(F.lit("Interim Dividend - Rs "), a, F.lit(".50 Per Share")),
            F.lit("Rights 1:5 @ Premium Rs 90"),
            F.lit("Interest Payment"),
            F.lit("Annual General Meeting / AGM"),
            F.lit("Scheme of Demerger"),
            F.lit("Amalgamation"),
            F.lit("Buyback of shares"),
            F.lit("Change of name"),
        ]
        purpose = F.lit(None).cast("string")
        for i in reversed(range(len(texts))):
            purpose = F.when(n == i, texts[i]).otherwise(purpose)
        return (
            self.trades.groupBy("symbol", "suppkey", F.year("trade_date").alias("y"))
            .agg(F.min("trade_date").alias("ex_date"))
            .select("symbol", "ex_date", purpose.alias("purpose"))
        )

    @cached_property
    def lines(self) -> int:
        """Rows of the line items, read off the file footers."""
        return self.table("lineitem").count()

    @cached_property
    def deals(self) -> DataFrame:
        li = self.table("lineitem").select(
            "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_linestatus", "l_returnflag"
        )
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        customer = self.table("customer").select("c_custkey", "c_name")
        # a task sorts its line items for the join and most readers then count groups of nearly one row, so tasks go by rows
        li = dealt(li, "l_orderkey", rows=self.lines)
        # the two smaller tables meet first, so the line items are shuffled once
        buyers = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_orderdate", "c_name")
        return (
            li.join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                F.to_date("o_orderdate").alias("deal_date"),
                F.concat(F.lit("S"), F.col("l_suppkey")).alias("symbol"),
                F.col("c_name").alias("client_name"),
                F.col("l_quantity").cast("bigint").alias("quantity"),
                (F.col("l_extendedprice") / F.col("l_quantity")).alias("avg_price"),
                F.col("l_extendedprice").alias("value"),
                F.when(F.col("l_linestatus") == "O", "BULK").otherwise("BLOCK").alias("deal_type"),
                F.when(F.col("l_returnflag") == "R", "SELL").otherwise("BUY").alias("transaction_type"),
                F.col("l_orderkey").alias("deal_no"),
                F.col("l_linenumber").alias("deal_line"),
            )
        )

    @cached_property
    def listings(self) -> DataFrame:
        """Instruments on two exchanges with overlapping and null ISINs, one row per source."""
        part = self.table("part")
        base = part.select(
            "p_partkey",
            F.when(F.col("p_size") == 1, None).otherwise(F.concat(F.lit("IN"), F.col("p_partkey"))).alias("isin"),
            F.concat(F.lit("P"), F.col("p_partkey")).alias("symbol"),
            F.col("p_name").alias("company_name"),
            F.col("p_retailprice").alias("close"),
            F.col("p_size").cast("bigint").alias("volume"),
            F.col("p_brand").alias("grp"),
        )
        a = base.filter(F.col("p_partkey") % 3 != 0).withColumn("source", F.lit("A"))
        b = base.filter(F.col("p_partkey") % 2 == 0).withColumn("source", F.lit("B"))
        return a.unionByName(b).drop("p_partkey")

    @cached_property
    def constituents(self) -> DataFrame:
        """Index membership events: everything is added first, then removed or rebalanced."""
        part = self.table("part").withColumn("kk", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
        m = F.pmod(F.col("p_size") + F.col("kk"), F.lit(10))
        action = (
            F.when(F.col("kk") == 0, "ADD").when(m == 0, "REMOVE").when(m.isin(1, 2, 3), "REBALANCE")
        )
        return part.select(
            F.col("p_brand").alias("index_name"),
            F.concat(F.lit("P"), F.expr("p_partkey div 25")).alias("symbol"),
            F.col("p_name").alias("company_name"),
            F.expr("CASE kk WHEN 0 THEN DATE'2024-01-01' WHEN 1 THEN DATE'2024-04-01' ELSE DATE'2024-07-01' END").alias(
                "effective_date"
            ),
            action.alias("action"),
            F.when(F.col("p_partkey") % 17 == 0, None)
            .otherwise(F.round(F.col("p_retailprice") / 100 + F.col("kk"), 4))
            .alias("weight"),
            F.col("p_type").alias("sector"),
            F.col("p_partkey").alias("partkey"),
        ).filter(F.col("action").isNotNull())

    @cached_property
    def master_changes(self) -> DataFrame:
        """Daily snapshots of a dimension: one status per customer and day."""
        return (
            self.table("orders")
            .groupBy(F.concat(F.lit("C"), F.col("o_custkey")).alias("symbol"), F.to_date("o_orderdate").alias("as_of"))
            .agg(F.max_by("o_orderstatus", "o_orderkey").alias("status"))
        )

    @cached_property
    def macro(self) -> DataFrame:
        return (
            self.table("orders")
            .groupBy(
                F.col("o_orderpriority").alias("indicator_code"),
                F.trunc("o_orderdate", "MM").alias("indicator_date"),
            )
            .agg(F.round(F.avg("o_totalprice") + 1e-9, 2).alias("value"))
        )

    @cached_property
    def financials(self) -> DataFrame:
        li = self.table("lineitem").select(
            "l_suppkey", "l_shipdate", "l_extendedprice", "l_discount", "l_tax", "l_quantity"
        )
        agg = li.groupBy("l_suppkey", F.year("l_shipdate").alias("year"), F.quarter("l_shipdate").alias("quarter")).agg(
            F.round(F.sum("l_extendedprice"), 2).alias("revenue"),
            F.round(F.sum(F.col("l_extendedprice") * (F.lit(0.1) - F.col("l_discount"))) + 1e-9, 2).alias("net_profit"),
            F.sum("l_quantity").cast("bigint").alias("units"),
            F.count("*").alias("n"),
        )
        sup = self.table("supplier").select("s_suppkey", "s_acctbal")
        return agg.join(sup, F.col("l_suppkey") == F.col("s_suppkey")).select(
            F.concat(F.lit("S"), F.col("l_suppkey")).alias("symbol"),
            F.last_day(F.make_date("year", F.col("quarter") * 3, F.lit(1))).alias("period_end_date"),
            "year",
            "quarter",
            "revenue",
            "net_profit",
            F.round(F.col("revenue") * 0.2 + 1e-9, 2).alias("operating_profit"),
            F.round(F.col("s_acctbal") * 100, 2).alias("equity"),
            F.round(F.col("revenue") * 1.5 + 1e-9, 2).alias("total_assets"),
            F.when(F.col("l_suppkey") % 7 == 0, 0.0)
            .otherwise(F.round(F.abs("s_acctbal") * 50, 2))
            .alias("total_debt"),
            F.col("units").cast("double").alias("current_assets"),
            F.when(F.col("l_suppkey") % 5 == 0, None).otherwise(F.col("n") * 10.0).alias("current_liabilities"),
            F.round(F.col("net_profit") / F.col("units") + 1e-9, 4).alias("eps"),
        )

    @cached_property
    def shareholding(self) -> DataFrame:
        """Quarter-end holdings per supplier that traded in the quarter."""
        li = self.table("lineitem").select("l_suppkey", "l_shipdate").groupBy(
            "l_suppkey", F.year("l_shipdate").alias("year"), F.quarter("l_shipdate").alias("quarter")
        ).agg(F.count("*").alias("n"))
        s, t = F.col("l_suppkey"), F.col("year") * 4 + F.col("quarter")
        return li.select(
            F.concat(F.lit("S"), s).alias("symbol"),
            F.last_day(F.make_date("year", F.col("quarter") * 3, F.lit(1))).alias("quarter_end_date"),
            "year",
            "quarter",
            (F.pmod(s * 7 + t, F.lit(60)) + 20.0).alias("promoter"),
            (F.pmod(s * 3 + t, F.lit(15)) + 0.5).alias("fii"),
            (F.pmod(s * 5 + t * 2, F.lit(11)) + 0.25).alias("dii"),
            (F.pmod(s + t * 3, F.lit(25)) + 1.0).alias("institutional"),
            F.when(F.pmod(s + t, F.lit(3)) == 0, 0.0).otherwise(F.pmod(s * 11 + t, F.lit(9)) + 0.5).alias("pledged"),
        )

    @cached_property
    def holidays(self) -> DataFrame:
        """One holiday per nation, month and day taken from its key."""
        return self.table("nation").select(
            (F.col("n_nationkey") % 12 + 1).alias("mm"),
            (F.col("n_nationkey") % 28 + 1).alias("dd"),
            F.col("n_name").alias("holiday_name"),
        )

    @cached_property
    def ticks(self) -> DataFrame:
        return self.table("events").select(
            "event_id",
            F.col("ts").cast("timestamp").alias("ts"),
            F.concat(F.lit("U"), F.col("user_id")).alias("entity"),
            F.col("event_type").alias("kind"),
            F.col("value").alias("price"),
            "props",
        )


def _case_text() -> str:
    return """CASE pmod(suppkey + y, 13)
 WHEN 0 THEN 'Face Value Split From Rs 10/- To Rs ' || a || '/- Per Share'
 WHEN 1 THEN 'Sub-Division from Rs. 100/- to Rs. ' || (a * 10) || '/-'
 WHEN 2 THEN 'Bonus issue ' || a || ':2'
 WHEN 3 THEN 'Capitalisation ' || a || ' for 3'
 WHEN 4 THEN 'Interim Dividend - Rs ' || a || '.50 Per Share'
 WHEN 5 THEN 'Rights 1:5 @ Premium Rs 90'
 WHEN 6 THEN 'Interest Payment'
 WHEN 7 THEN 'Annual General Meeting / AGM'
 WHEN 8 THEN 'Scheme of Demerger'
 WHEN 9 THEN 'Amalgamation'
 WHEN 10 THEN 'Buyback of shares'
 WHEN 11 THEN 'Change of name' END""".replace("pmod(suppkey + y, 13)", "((suppkey + y) % 13)")


#: name -> (relations it needs, defining SQL)
SQL: dict[str, tuple[tuple[str, ...], str]] = {
    "trades": (
        (),
        """SELECT 'S' || l_suppkey AS symbol, l_suppkey AS suppkey, CAST(l_shipdate AS DATE) AS trade_date,
 l_extendedprice / l_quantity AS px,
 row(l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity) AS k,
 l_quantity AS qty, l_extendedprice AS amount FROM lineitem""",
    ),
    "ohlc": (
        ("trades",),
        """SELECT symbol, suppkey, trade_date, arg_min(px, k) AS open, max(px) AS high, min(px) AS low,
 arg_max(px, k) AS close, CAST(sum(qty) AS BIGINT) AS volume, round(sum(amount), 2) AS turnover,
 count(*) AS trades FROM trades GROUP BY ALL""",
    ),
    "dirty": (
        ("ohlc",),
        f"""SELECT * EXCLUDE (tag) FROM (SELECT {", ".join(f"{e} AS {c}" for c, e in DIRTY_COLUMNS.items())}, tag
   FROM (SELECT *, {DIRTY_TAG} AS tag FROM ohlc)
 UNION ALL SELECT {", ".join((f"concat({e}, '#2')" if c == "event_id" else e) + f" AS {c}" for c, e in DIRTY_COLUMNS.items())}, tag
   FROM (SELECT *, {DIRTY_TAG} AS tag FROM ohlc) WHERE tag = 17)""",
    ),
    "ca": (
        ("trades",),
        """SELECT symbol, ex_date,
 CASE n WHEN 0 THEN 'SPLIT' WHEN 1 THEN 'BONUS' WHEN 2 THEN 'DIVIDEND' ELSE 'OTHER' END AS action_type,
 CAST(CASE n WHEN 0 THEN 2.0 WHEN 1 THEN 1.5 WHEN 2 THEN 0.98 ELSE 1.0 END AS DOUBLE) AS adjustment_factor,
 CASE WHEN n = 2 THEN CAST(suppkey % 20 + 1 AS DOUBLE) END AS dividend_amount
 FROM (SELECT symbol, suppkey, year(trade_date) AS y, min(trade_date) AS ex_date,
   (suppkey + year(trade_date)) % 4 AS n FROM trades GROUP BY ALL)""",
    ),
    "ca_text": (
        ("trades",),
        f"""SELECT symbol, ex_date, {_case_text()} AS purpose
 FROM (SELECT symbol, suppkey, year(trade_date) AS y, min(trade_date) AS ex_date, suppkey % 4 + 1 AS a
   FROM trades GROUP BY ALL)""",
    ),
    "deals": (
        (),
        """SELECT CAST(o_orderdate AS DATE) AS deal_date, 'S' || l_suppkey AS symbol, c_name AS client_name,
 CAST(l_quantity AS BIGINT) AS quantity, l_extendedprice / l_quantity AS avg_price, l_extendedprice AS value,
 CASE WHEN l_linestatus = 'O' THEN 'BULK' ELSE 'BLOCK' END AS deal_type,
 CASE WHEN l_returnflag = 'R' THEN 'SELL' ELSE 'BUY' END AS transaction_type,
 l_orderkey AS deal_no, l_linenumber AS deal_line
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
    ),
    "listings": (
        (),
        """SELECT CASE WHEN p_size = 1 THEN NULL ELSE 'IN' || p_partkey END AS isin, 'P' || p_partkey AS symbol,
 p_name AS company_name, p_retailprice AS close, CAST(p_size AS BIGINT) AS volume, p_brand AS grp, s.source
 FROM part, (VALUES ('A'), ('B')) s(source)
 WHERE (s.source = 'A' AND p_partkey % 3 <> 0) OR (s.source = 'B' AND p_partkey % 2 = 0)""",
    ),
    "constituents": (
        (),
        """SELECT * FROM (SELECT p_brand AS index_name, 'P' || (p_partkey // 25) AS symbol, p_name AS company_name,
 CASE kk WHEN 0 THEN DATE '2024-01-01' WHEN 1 THEN DATE '2024-04-01' ELSE DATE '2024-07-01' END AS effective_date,
 CASE WHEN kk = 0 THEN 'ADD' WHEN (p_size + kk) % 10 = 0 THEN 'REMOVE'
   WHEN (p_size + kk) % 10 IN (1, 2, 3) THEN 'REBALANCE' END AS action,
 CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE round(p_retailprice / 100 + kk, 4) END AS weight,
 p_type AS sector, p_partkey AS partkey
 FROM part, (VALUES (0), (1), (2)) v(kk)) WHERE action IS NOT NULL""",
    ),
    "master_changes": (
        (),
        """SELECT 'C' || o_custkey AS symbol, CAST(o_orderdate AS DATE) AS as_of, arg_max(o_orderstatus, o_orderkey) AS status
 FROM orders GROUP BY 1, 2""",
    ),
    "macro": (
        (),
        """SELECT o_orderpriority AS indicator_code, CAST(date_trunc('month', o_orderdate) AS DATE) AS indicator_date,
 round(avg(o_totalprice) + 1e-9, 2) AS value FROM orders GROUP BY 1, 2""",
    ),
    "financials": (
        (),
        """SELECT 'S' || l_suppkey AS symbol, last_day(make_date(year, quarter * 3, 1)) AS period_end_date,
 CAST(year AS INTEGER) AS year, CAST(quarter AS INTEGER) AS quarter, revenue, net_profit,
 round(revenue * CAST(0.2 AS DOUBLE) + 1e-9, 2) AS operating_profit, round(s_acctbal * 100, 2) AS equity,
 round(revenue * CAST(1.5 AS DOUBLE) + 1e-9, 2) AS total_assets,
 CASE WHEN l_suppkey % 7 = 0 THEN CAST(0.0 AS DOUBLE) ELSE round(abs(s_acctbal) * 50, 2) END AS total_debt,
 CAST(units AS DOUBLE) AS current_assets,
 CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE CAST(n * 10 AS DOUBLE) END AS current_liabilities,
 round(net_profit / units + 1e-9, 4) AS eps
 FROM (SELECT l_suppkey, year(l_shipdate) AS year, quarter(l_shipdate) AS quarter,
   round(sum(l_extendedprice), 2) AS revenue,
   round(sum(l_extendedprice * (CAST(0.1 AS DOUBLE) - l_discount)) + 1e-9, 2) AS net_profit,
   CAST(sum(l_quantity) AS BIGINT) AS units, count(*) AS n FROM lineitem GROUP BY 1, 2, 3)
 JOIN supplier ON l_suppkey = s_suppkey""",
    ),
    "shareholding": (
        (),
        """SELECT 'S' || s AS symbol, last_day(make_date(year, quarter * 3, 1)) AS quarter_end_date,
 CAST(year AS INTEGER) AS year, CAST(quarter AS INTEGER) AS quarter,
 CAST((s * 7 + t) % 60 + 20 AS DOUBLE) AS promoter, (s * 3 + t) % 15 + CAST(0.5 AS DOUBLE) AS fii,
 (s * 5 + t * 2) % 11 + CAST(0.25 AS DOUBLE) AS dii, CAST((s + t * 3) % 25 + 1 AS DOUBLE) AS institutional,
 CASE WHEN (s + t) % 3 = 0 THEN CAST(0.0 AS DOUBLE) ELSE (s * 11 + t) % 9 + CAST(0.5 AS DOUBLE) END AS pledged
 FROM (SELECT l_suppkey AS s, year(l_shipdate) AS year, quarter(l_shipdate) AS quarter,
   year(l_shipdate) * 4 + quarter(l_shipdate) AS t FROM lineitem GROUP BY ALL)""",
    ),
    "holidays": (
        (),
        "SELECT n_nationkey % 12 + 1 AS mm, n_nationkey % 28 + 1 AS dd, n_name AS holiday_name FROM nation",
    ),
    "calendar": (
        ("holidays",),
        """SELECT d AS trade_date,
 (h.holiday_name IS NULL AND isodow(d) < 6) AS is_trading_day,
 CASE WHEN h.holiday_name IS NOT NULL THEN 'MARKET_HOLIDAY' WHEN isodow(d) >= 6 THEN 'WEEKEND'
   ELSE 'NORMAL_TRADING' END AS day_type, h.holiday_name, CAST(isodow(d) AS INTEGER) AS weekday
 FROM (SELECT CAST(unnest(generate_series(make_date(year(min(o_orderdate)), 1, 1)::TIMESTAMP,
   make_date(year(max(o_orderdate)), 12, 31)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS d FROM orders)
 LEFT JOIN holidays h ON month(d) = h.mm AND day(d) = h.dd""",
    ),
    "ticks": (
        (),
        """SELECT event_id, ts, 'U' || user_id AS entity, event_type AS kind, value AS price, props FROM events""",
    ),
}


def with_sql(*names: str, body: str) -> str:
    """``WITH`` the named relations (and what they need) in front of ``body``.

    ``body`` may itself start with further comma-led common table expressions.
    """
    order: list[str] = []

    def visit(name: str) -> None:
        for need in SQL[name][0]:
            visit(need)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    ctes = ",\n".join(f"{n} AS ({SQL[n][1]})" for n in order)
    return f"WITH {ctes}\n{body}"
