"""Feed files and documents rendered from the market relations, for the round-trip queries.

The given tables hold no exchange files, so each ingest query writes its own in the feed's format
(with the defects the feed is known for) into the shared folder and reads them back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake import schemas
from ticklake.bridge import Market
from ticklake.session import fresh_path


def text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def day_text(c: str, fmt: str = "yyyy-MM-dd") -> Column:
    return F.date_format(c, fmt)


#: bars whose symbol cell is left blank, as Spark text and as SQL
BLANK_SYMBOL = "(suppkey * 7 + dayofyear(trade_date)) % 97 = 0"


def price_cells(m: Market) -> DataFrame:
    """Bars as text cells of the first feed, keyed by feed column."""
    f = {c: F.lit("").alias(c) for c in schemas.PRICE_FEED}
    f |= {
        "TradDt": day_text("trade_date"),
        "BizDt": day_text("trade_date"),
        "Sgmt": F.lit("CM"),
        "Src": F.lit("NSE"),
        "FinInstrmTp": F.lit("STK"),
        "FinInstrmId": text("suppkey"),
        "ISIN": F.concat(F.lit("INE"), F.lpad(text("suppkey"), 8, "0"), text(F.col("suppkey") % 10)),
        "TckrSymb": F.when(F.expr(BLANK_SYMBOL), F.lit("")).otherwise(F.col("symbol")),
        "SctySrs": F.lit("EQ"),
        "OpnPric": text("open"),
        "HghPric": text("high"),
        "LwPric": text("low"),
        "ClsPric": text("close"),
        "LastPric": F.when(F.col("suppkey") % 5 == 0, F.lit("-")).otherwise(text("close")),
        "SttlmPric": F.when(F.col("suppkey") % 3 == 0, F.lit("N/A")).otherwise(text("close")),
        "TtlTradgVol": text("volume"),
        "TtlTrfVal": text("turnover"),
        "TtlNbOfTxsExctd": text("trades"),
    }
    return m.ohlc.select(*[v.alias(c) for c, v in f.items()])


def write_csv(m: Market, cells: DataFrame, label: str) -> str:
    path = fresh_path(m.spark, label)
    cells.write.option("header", True).option("quoteAll", True).csv(path)
    return path


def price_file(m: Market) -> str:
    """Price files with blanks around some header names."""
    cells = price_cells(m)
    return write_csv(m, cells.withColumnsRenamed({"TradDt": " TradDt", "ClsPric": "ClsPric "}), "prices")


def second_price_file(m: Market) -> str:
    cells = m.ohlc.select(
        text("suppkey").alias("SC_CODE"),
        F.when(F.expr(BLANK_SYMBOL), F.lit("")).otherwise(F.col("symbol")).alias("SC_NAME"),
        F.lit("A").alias("SC_GROUP"), F.lit("Q").alias("SC_TYPE"),
        text("open").alias("OPEN"), text("high").alias("HIGH"), text("low").alias("LOW"), text("close").alias("CLOSE"),
        F.lit("null").alias("LAST"), F.lit("-").alias("PREVCLOSE"),
        text("trades").alias("NO_TRADES"), text("volume").alias("NO_OF_SHRS"), text("turnover").alias("NET_TURNOV"),
        F.lit("").alias("TDCLOINDI"),
        F.when(F.col("suppkey") % 4 == 0, F.lit("NULL")).otherwise(F.concat(F.lit("IN"), text("suppkey"))).alias("ISIN_CODE"),
    )
    return write_csv(m, cells, "second-prices")


def documents(df: DataFrame, doc_id: Column, **body: Column) -> DataFrame:
    """One JSON document per row with the given top-level members."""
    return df.select(doc_id.alias("doc_id"), F.to_json(F.struct(*[v.alias(k) for k, v in body.items()])).alias("doc"), *df.columns)
