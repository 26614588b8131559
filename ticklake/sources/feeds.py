"""CSV feeds: daily prices of two exchanges, symbol master, corporate actions, deals, results master.

Readers take a file, folder or glob, so many days are one job.  Cells arrive as text; missing
tokens become null before any cast.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake import schemas
from ticklake.functions.actions import action_type, dividend_amount, text_factor
from ticklake.functions.envelope import with_envelope
from ticklake.functions.text import MASTER_NULLS, PRICE_NULLS, clean, parse_date, safe_double, safe_long
from ticklake.quality.shape import SchemaMismatch, check_columns, column_diff

HEADERS_AT_ONCE = 16

# Formats of the trade date.
TRADE_DATES = ("yyyy-M-d", "yyyyMMdd")


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """Every column as text, header names trimmed, nameless columns dropped.

    Each file is read by its own header: files are grouped by their first line, a group is one read, and groups meet
    by column name.  Files whose columns differ as a set end the read with their names.
    """
    groups = _header_groups(spark, path)
    parts = {files[0]: _trimmed(spark.read.option("header", True).option("mode", "PERMISSIVE").csv(files)) for files in groups}
    if not parts:
        return _trimmed(spark.read.option("header", True).csv(path))
    first_file, first = next(iter(parts.items()))
    for file, part in parts.items():
        if set(part.columns) != set(first.columns):
            missing, extra = column_diff(part.columns, first.columns)
            raise SchemaMismatch(f"{file} and {first_file} differ: missing columns {missing}, unexpected columns {extra}")
    return reduce(DataFrame.unionByName, parts.values())


def _header_groups(spark: SparkSession, path: str) -> list[list[str]]:
    """Files below ``path`` by equal first line.

    Only first lines are read, one small read a file and many at a time, from the list of files that any read of the
    folder makes; the data are scanned once, by the read that follows.  Files without a line are left out.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    files = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)) for f in sorted(spark.read.text(path).inputFiles())]
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first_line(file) -> str | None:
        stream = file.getFileSystem(conf).open(file)
        codec = codecs.getCodec(file)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
        try:
            return reader.readLine()
        finally:
            reader.close()

    groups: dict[str, list[str]] = {}
    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        for file, header in zip(files, pool.map(first_line, files), strict=True):
            if header is not None:
                groups.setdefault(header, []).append(file.toString())
    return [groups[h] for h in sorted(groups)]


def _trimmed(df: DataFrame) -> DataFrame:
    trimmed = df.toDF(*[c.strip() for c in df.columns])
    return trimmed.select(*[F.col(f"`{c}`") for c in trimmed.columns if c and not c.startswith("_c")])


def typed(df: DataFrame, layout: dict[str, str], tokens, strict: bool) -> DataFrame:
    """Text cells as the layout's types; the column set must be exactly the layout's."""
    check_columns(df.columns, list(layout))
    cols = []
    for name, kind in layout.items():
        text = clean(F.col(f"`{name}`"), tokens)
        if kind == "string":
            cols.append(text.alias(name))
        elif kind == "double":
            cols.append((text.cast("double") if strict else safe_double(text, tokens)).alias(name))
        else:
            cols.append((text.cast("bigint") if strict else safe_long(text, tokens)).alias(name))
    return df.select(*cols)


def read_prices(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Daily prices of the first exchange, 34 columns.  A bad number stops a strict read and is null
    in a lenient one, which also gives a missing instrument id the value 0."""
    df = typed(read_text_csv(spark, path), schemas.PRICE_FEED, PRICE_NULLS, strict)
    if not strict:
        df = df.withColumn("FinInstrmId", F.coalesce("FinInstrmId", F.lit("0")))
    return df.filter(F.col("TckrSymb").isNotNull())


def read_second_prices(spark: SparkSession, path: str) -> DataFrame:
    """Daily prices of the second exchange; rows need a code and a name."""
    df = typed(read_text_csv(spark, path), schemas.SECOND_FEED, PRICE_NULLS, True)
    return df.filter(F.col("SC_CODE").isNotNull() & F.col("SC_NAME").isNotNull())


# Second-exchange column each first-exchange column is filled from.
SECOND_TO_FIRST = {
    "TckrSymb": "SC_NAME", "ISIN": "ISIN_CODE", "FinInstrmId": "SC_CODE", "OpnPric": "OPEN", "HghPric": "HIGH",
    "LwPric": "LOW", "ClsPric": "CLOSE", "LastPric": "LAST", "PrvsClsgPric": "PREVCLOSE",
    "TtlTradgVol": "NO_OF_SHRS", "TtlTrfVal": "NET_TURNOV", "TtlNbOfTxsExctd": "NO_TRADES", "Sgmt": "SC_GROUP",
    "SctySrs": "SC_GROUP", "FinInstrmNm": "SC_NAME", "SsnId": "TDCLOINDI",
}


def second_to_first(df: DataFrame, trade_date: Column) -> DataFrame:
    """Second-exchange rows in the 34 columns of the first; what it lacks is a typed null."""
    day = F.date_format(trade_date, "yyyy-MM-dd")
    constant = {"TradDt": day, "BizDt": day, "Src": F.lit("BSE"), "FinInstrmTp": F.lit("STK")}
    cols = []
    for name, kind in schemas.PRICE_FEED.items():
        if name in constant:
            value = constant[name]
        elif name in SECOND_TO_FIRST:
            value = F.col(SECOND_TO_FIRST[name])
        else:
            value = F.lit(None)
        cols.append(value.cast(kind).alias(name))
    return df.select(*cols)


def price_events(df: DataFrame, source: str, exchange: str, ingest_time: str) -> DataFrame:
    """Raw price rows with their envelope.

    Ids name source, day, symbol and instrument (the second exchange: source, day and code), so the
    same row gets the same id in every run.
    """
    day = parse_date(F.col("TradDt"), TRADE_DATES)
    known = ["FinInstrmId"] if exchange == "BSE" else ["TckrSymb", "FinInstrmId"]
    parts = [F.concat(F.lit(":"), F.coalesce(F.col(c), F.lit("None"))) for c in known]
    name = F.concat(F.lit(f"{source}:"), F.date_format(day, "yyyy-MM-dd"), *parts)
    entity = F.concat("TckrSymb", F.lit(":"), "FinInstrmId", F.lit(f":{exchange}"))
    return with_envelope(df, source, "v1", name, entity, day, ingest_time)


def normalize_prices(events: DataFrame, exchange: str = "NSE") -> DataFrame:
    """Canonical price rows: named symbol and positive close, canonical names, default factor."""
    keep = F.col("TckrSymb").isNotNull() & (F.col("TckrSymb") != "") & (F.col("ClsPric") > 0)
    return events.filter(keep).select(
        "event_id", "event_time", "ingest_time", "source", "schema_version", "entity_id",
        F.concat_ws(":", "TckrSymb", F.lit(exchange)).alias("instrument_id"),
        F.col("TckrSymb").alias("symbol"),
        F.lit(exchange).alias("exchange"),
        F.col("ISIN").alias("isin"),
        F.col("FinInstrmTp").alias("instrument_type"),
        F.col("SctySrs").alias("series"),
        parse_date(F.col("TradDt"), TRADE_DATES).alias("trade_date"),
        F.col("PrvsClsgPric").alias("prev_close"),
        F.col("OpnPric").alias("open"),
        F.col("HghPric").alias("high"),
        F.col("LwPric").alias("low"),
        F.col("ClsPric").alias("close"),
        F.col("LastPric").alias("last_price"),
        F.col("SttlmPric").alias("settlement_price"),
        F.col("TtlTradgVol").alias("volume"),
        F.col("TtlTrfVal").alias("turnover"),
        F.col("TtlNbOfTxsExctd").alias("trades"),
        F.lit(1.0).alias("adjustment_factor"),
        F.lit(None).cast("date").alias("adjustment_date"),
        F.lit(True).alias("is_trading_day"),
    )


def to_serving_names(df: DataFrame) -> DataFrame:
    """Normalised names replaced by the serving table's, only those present."""
    return df.withColumnsRenamed({k: v for k, v in schemas.SERVING_NAMES.items() if k in df.columns})


def read_master(spark: SparkSession, path: str, valid_from: str) -> DataFrame:
    """Symbol master: repeated headers dropped, listing dates parsed, all rows active from ``valid_from``."""
    df = typed(
        read_text_csv(spark, path).filter(F.col("SYMBOL") != "SYMBOL"), schemas.MASTER_FEED, MASTER_NULLS, False
    ).filter(F.col("SYMBOL").isNotNull())
    return df.select(
        F.concat_ws(":", "SYMBOL", F.lit("NSE")).alias("instrument_id"),
        F.col("SYMBOL").alias("symbol"),
        F.col("NAME OF COMPANY").alias("company_name"),
        F.col("SERIES").alias("series"),
        parse_date(F.col("DATE OF LISTING"), ("d-MMM-yyyy",)).alias("listing_date"),
        F.col("PAID UP VALUE").alias("paid_up_value"),
        F.col("MARKET LOT").alias("lot_size"),
        F.col("ISIN NUMBER").alias("isin"),
        F.col("FACE VALUE").alias("face_value"),
        F.lit("ACTIVE").alias("status"),
        F.lit(valid_from).cast("date").alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
    )


def read_actions(spark: SparkSession, path: str) -> DataFrame:
    """Corporate actions with kind, factor, dividend and parsed dates; unreadable cells are null."""
    df = read_text_csv(spark, path)
    check_columns(df.columns, list(schemas.ACTION_FEED))
    purpose = F.col("PURPOSE")
    kind = action_type(purpose)
    return df.select(
        clean(F.col("SYMBOL")).alias("symbol"),
        clean(F.col("COMPANY")).alias("company_name"),
        clean(F.col("SERIES")).alias("series"),
        purpose.alias("purpose"),
        kind.alias("action_type"),
        text_factor(kind, purpose).alias("adjustment_factor"),
        F.when(kind == "DIVIDEND", dividend_amount(purpose)).alias("dividend_amount"),
        parse_date(F.col("`EX-DATE`")).alias("ex_date"),
        parse_date(F.col("`RECORD DATE`")).alias("record_date"),
    )


# Header spellings of the deals feed.
DEAL_ALIASES = {
    "symbol": ("Symbol", "SYMBOL"),
    "client_name": ("ClientName", "CLIENT_NAME"),
    "security_name": ("SecurityName", "SECURITY_NAME"),
    "side": ("Buy/Sell", "BuySell", "BUY_SELL"),
    "quantity": ("QuantityTraded", "Qty", "QTY"),
    "price": ("TradePrice/Wght.Avg.Price", "TradePriceWght.Avg.Price", "TradePrice", "PRICE"),
    "remarks": ("Remarks", "REMARKS"),
}


def read_deals(spark: SparkSession, path: str, deal_type: str) -> DataFrame:
    """Deals CSV: thousands separators, unreadable numbers are 0, rows need symbol, side and quantity."""
    df = read_text_csv(spark, path)

    def pick(field: str) -> Column:
        present = [F.col(f"`{a}`") for a in DEAL_ALIASES[field] if a in df.columns]
        return F.trim(F.coalesce(*[F.nullif(c, F.lit("")) for c in present], F.lit("")))

    rows = df.select(
        pick("symbol").alias("symbol"),
        pick("client_name").alias("client_name"),
        F.upper(pick("side")).alias("transaction_type"),
        F.coalesce(safe_long(pick("quantity")), F.lit(0)).alias("quantity"),
        F.coalesce(safe_double(pick("price")), F.lit(0.0)).alias("avg_price"),
        F.lit(deal_type).alias("deal_type"),
        pick("remarks").alias("remarks"),
    )
    return rows.filter("symbol <> '' AND transaction_type <> '' AND quantity > 0")


# Results-master names and their canonical form.
RESULT_NAMES = {
    "companyName": "company_name", "financialYear": "year", "filingDate": "filing_date", "fromDate": "period_start",
    "toDate": "period_end_date", "period": "period_type", "isin": "cin",
}
# Formats of the dates in results.
DATE_GUESSES = ("yyyy-M-d", "d-MMM-yyyy", "d-M-yyyy")


def normalize_results(df: DataFrame, only_audited: bool = False) -> DataFrame:
    """Results master: canonical names, dates, ISO stamps, year and quarter, and the document address."""
    audited = next((c for c in df.columns if "audited" in c.strip().lower()), None)
    if only_audited and audited is not None:
        df = df.filter(F.lower(F.trim(F.col(f"`{audited}`"))) == "audited")
    out = df.withColumnsRenamed({k: v for k, v in RESULT_NAMES.items() if k in df.columns})
    if "year" in out.columns:
        out = out.withColumn("year", F.coalesce(F.col("year").try_cast("double").try_cast("int"), F.lit(0)))
    for c in ("period_start", "period_end_date", "filing_date"):
        if c in out.columns:
            out = out.withColumn(c, parse_date(F.col(c), DATE_GUESSES))
    for c in ("exchdisstime", "broadCastDate"):
        if c in out.columns:
            stamp = F.coalesce(
                F.try_to_timestamp(F.col(c), F.lit("d-MMM-yyyy HH:mm:ss")), F.try_to_timestamp(F.col(c), F.lit("yyyy-MM-dd HH:mm:ss"))
            )
            out = out.withColumn(c, F.date_format(stamp, "yyyy-MM-dd HH:mm:ss"))
    named = F.lit(None).cast("int")
    if "period_type" in out.columns:
        named = F.regexp_extract("period_type", "Q([1-4])", 1).try_cast("int")
    ended = F.quarter("period_end_date") if "period_end_date" in out.columns else F.lit(None).cast("int")
    out = out.withColumn("quarter", F.coalesce(named, ended, F.lit(0)))
    address = next((c for c in out.columns if "xbrl" in c.lower()), None)
    related = next((c for c in out.columns if "relat" in c.lower()), None)
    url = F.lit(None).cast("string")
    if address is not None:
        url = clean(F.col(f"`{address}`"))
    elif related is not None:
        url = F.when(F.trim(F.col(f"`{related}`")).startswith("http"), F.trim(F.col(f"`{related}`")))
    return out.withColumn("document_url", url)
