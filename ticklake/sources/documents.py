"""JSON, HTML and XBRL documents: one row per document in, typed rows out.

``read_documents`` reads a whole folder as one job.  A document that does not parse yields an
``error`` row where the caller asks for it, and no data rows.  JSON objects are read as string
maps, so spelling variants of a key are plain lookups.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ticklake.functions.actions import index_category
from ticklake.functions.envelope import uuid5
from ticklake.functions.text import clean, last_segment, parse_date, parse_holiday, safe_double, safe_long
from ticklake.session import fresh_path

OBJECT = "map<string,string>"
OBJECTS = "array<map<string,string>>"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Files below ``path`` as (doc_id, doc)."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    return files.select(F.col("_metadata.file_path").alias("doc_id"), F.col("value").alias("doc"))


def _first(m: Column, *keys: str) -> Column:
    return F.coalesce(*[F.nullif(m[k], F.lit("")) for k in keys])


def _list_under(doc: Column, *keys: str) -> Column:
    """The document itself when it is a list, else the first list found under one of ``keys``."""
    whole = F.when(F.ltrim(doc).startswith("["), F.from_json(doc, OBJECTS))
    return F.coalesce(whole, *[F.from_json(F.get_json_object(doc, f"$.{k}"), OBJECTS) for k in keys])


def document_errors(docs: DataFrame) -> DataFrame:
    """Documents that are not JSON, with the reason, instead of silently skipping them."""
    broken = F.get_json_object("doc", "$").isNull()
    return docs.filter(broken).select("doc_id", F.lit("not a JSON document").alias("error"))


FORMATS = ("json", "xml", "html", "empty", "unknown")


def document_format(doc: Column) -> Column:
    """What a document is by how it begins."""
    text = F.regexp_replace(F.coalesce(doc, F.lit("")), r"^[\uFEFF\s]+", "")
    return (
        F.when(text == "", "empty").when(text.rlike(r"^[{\[]"), "json").when(text.rlike(r"(?i)^<(\?xml|([a-z]+:)?xbrl)\b"), "xml")
        .when(text.startswith("<"), "html").otherwise("unknown")
    )


def batch_outcomes(docs: DataFrame) -> DataFrame:
    """One row per document of a folder in several formats: ``doc_id``, ``format``, ``records`` and ``error``.

    JSON counts its objects, XBRL its facts, HTML the one record of its holder tables.  A document that cannot be read
    has no records and the reason; it stops neither the others nor the job.

    Opening many small files costs more than what is in them, so each is read once: the documents are written by
    format first, and every reader below sees only its own.
    """
    marked = docs.withColumn("doc", F.regexp_replace("doc", "^\uFEFF", ""))  # a byte order mark is no part of the document
    typed = marked.withColumn("format", document_format(F.col("doc")))
    path = fresh_path(docs.sparkSession, "documents")
    typed.hint("rebalance", "format").write.partitionBy("format").parquet(path)
    typed = docs.sparkSession.read.schema(typed.schema).parquet(path)
    of = {f: typed.filter(F.col("format") == f) for f in FORMATS}
    objects = F.size(_list_under(F.col("doc"), "data", "corporates", "result", "items"))
    readable = F.get_json_object("doc", "$").isNotNull()
    json = of["json"].select(
        "doc_id", "format", F.when(readable, F.greatest(F.coalesce(objects, F.lit(0)), F.lit(0))).otherwise(0).cast("long").alias("records"),
        F.when(~readable, "not a JSON document").alias("error"),
    )
    facts = xbrl_facts(of["xml"].select("doc_id", "doc")).groupBy("doc_id").agg(F.count("tag").alias("records"), F.max("error").alias("error"))
    xml = of["xml"].select("doc_id", "format").join(facts, "doc_id", "left").withColumn("records", F.coalesce("records", F.lit(0)))
    tables = shareholding_tables(of["html"]).select("doc_id", F.lit(1).cast("long").alias("records"))
    html = of["html"].select("doc_id", "format").join(tables, "doc_id", "left").select(
        "doc_id", "format", F.coalesce("records", F.lit(0)).cast("long").alias("records"), F.when(F.col("records").isNull(), "no holder rows").alias("error")
    )
    none = [of[f].select("doc_id", "format", F.lit(0).cast("long").alias("records"), F.lit(why).alias("error")) for f, why in (("empty", "empty document"), ("unknown", "unknown format"))]
    return json.unionByName(xml.select("doc_id", "format", "records", "error")).unionByName(html).unionByName(none[0]).unionByName(none[1])


def corporate_actions(docs: DataFrame, effective: Column | None = None) -> DataFrame:
    """Corporate-action objects, listed directly or under data / corporates / result / items.

    Only readable ex-dates count; with ``effective`` only those on that date.
    """
    items = docs.select(F.explode(_list_under(F.col("doc"), "data", "corporates", "result", "items")).alias("m"))
    m = F.col("m")
    rows = items.select(
        m["symbol"].alias("symbol"),
        _first(m, "comp", "company").alias("company_name"),
        m["series"].alias("series"),
        _first(m, "subject", "purpose").alias("purpose"),
        parse_date(_first(m, "exDate", "EX-DATE", "ex_date"), ("d-MMM-yyyy", "d-M-yyyy", "yyyy-M-d")).alias("ex_date"),
        m["isin"].alias("isin"),
    ).filter("ex_date IS NOT NULL")
    return rows if effective is None else rows.filter(F.col("ex_date") == effective)


# Spellings of the keys of a deal object, by the column they fill.
DEAL_KEYS = {
    "symbol": ("symbol", "Symbol", "SYMBOL"),
    "client_name": ("clientName", "ClientName", "CLIENT_NAME"),
    "deal_date": ("dealDate", "DealDate"),
    "bought": ("buyQty", "BuyQty"),
    "bought_at": ("buyAvgPrice", "BuyAvgPrice"),
    "sold": ("sellQty", "SellQty"),
    "sold_at": ("sellAvgPrice", "SellAvgPrice"),
}


def _objects_with(doc: Column, keys: dict[str, tuple[str, ...]], rows: DataFrame, *kept: Column) -> DataFrame:
    """One row per object of a JSON list, each of ``keys`` the first of its spellings that is not empty.

    All spellings are fields of one declared type, so an object is parsed once and nothing is looked up by name.  Fields
    that differ in case only have no name of their own in a query; they are renamed by position.
    """
    fields = [(name, spelling) for name, spellings in keys.items() for spelling in spellings]
    object_type = StructType([StructField(spelling, StringType()) for _, spelling in fields])
    found = rows.select(*kept, F.inline(F.from_json(doc, ArrayType(object_type))))
    first = len(found.columns) - len(fields)
    names = [f"_f{i}" for i in range(len(fields))]
    found = found.toDF(*found.columns[:first], *names)
    picked = {
        name: F.coalesce(*[F.nullif(F.col(n), F.lit("")) for n, (of, _) in zip(names, fields) if of == name]) for name in keys
    }
    return found.select(*found.columns[:first], *[c.alias(name) for name, c in picked.items()])


def deals(docs: DataFrame, deal_type: Column) -> DataFrame:
    """Each deal object gives a BUY row and a SELL row where that side has quantity.

    Texts are picked first and cast after the unpivot: the two steps compile to separate small
    methods, which run several times faster than one large one.
    """
    texts = _objects_with(F.col("doc"), DEAL_KEYS, docs, deal_type.alias("deal_type"))
    sides = F.array(
        *[
            F.struct(F.lit(side).alias("transaction_type"), F.col(qty).alias("quantity"), F.col(price).alias("avg_price"))
            for side, qty, price in (("BUY", "bought", "bought_at"), ("SELL", "sold", "sold_at"))
        ]
    )
    return (
        texts.select("symbol", "client_name", "deal_date", "deal_type", F.inline(sides))
        .select(
            F.trim("symbol").alias("symbol"),
            F.trim("client_name").alias("client_name"),
            parse_date(F.col("deal_date"), ("d-MMM-yyyy", "yyyy-M-d")).alias("deal_date"),
            "deal_type",
            "transaction_type",
            safe_long(F.col("quantity")).alias("quantity"),
            safe_double(F.col("avg_price")).alias("avg_price"),
        )
        .filter("symbol IS NOT NULL AND quantity > 0")
    )


def constituents(docs: DataFrame, index_name: Column, effective: Column, action: Column) -> DataFrame:
    """Index members of series EQ or BE; nested meta values win over the top level."""
    rows = docs.select(
        index_name.alias("index_name"),
        effective.alias("effective_date"),
        action.alias("action"),
        F.explode(F.from_json(F.get_json_object("doc", "$.data"), OBJECTS)).alias("m"),
    ).withColumn("meta", F.from_json(F.col("m")["meta"], OBJECT))
    m, meta = F.col("m"), F.col("meta")

    def either(key: str) -> Column:
        return F.coalesce(clean(meta[key]), clean(m[key]))

    has_weight = F.map_contains_key("m", "indexWeight")
    out = rows.select(
        "index_name",
        F.trim(m["symbol"]).alias("symbol"),
        either("isin").alias("isin"),
        either("companyName").alias("company_name"),
        "effective_date",
        "action",
        F.when(has_weight, safe_double(m["indexWeight"])).otherwise(safe_double(m["weightage"])).alias("weight"),
        safe_double(m["ffmc"]).alias("free_float_market_cap"),
        safe_long(m["sharesForIndex"]).alias("shares_for_index"),
        index_category(F.col("index_name")).alias("index_category"),
        either("sector").alias("sector"),
        F.trim(m["series"]).alias("series"),
    ).filter("symbol <> '' AND series IN ('EQ', 'BE')").drop("series")
    entity = F.concat_ws(":", "index_name", "symbol")
    name = F.concat(F.lit("nse_index_constituent:"), entity, F.lit(":"), F.date_format("effective_date", "yyyy-MM-dd"))
    return out.select(uuid5(name).alias("event_id"), entity.alias("entity_id"), *out.columns)


def macro_flat(docs: DataFrame) -> DataFrame:
    """indicators[] with one observation each."""
    m = F.col("m")
    return docs.select(F.explode(F.from_json(F.get_json_object("doc", "$.indicators"), OBJECTS)).alias("m")).select(
        F.to_date(m["indicator_date"]).alias("indicator_date"),
        *[m[c].alias(c) for c in ("indicator_code", "indicator_name", "indicator_category", "unit", "frequency", "source")],
        m["value"].cast("double").alias("value"),
        F.concat_ws(":", m["indicator_code"], m["indicator_date"]).alias("entity_id"),
    )


def macro_series(docs: DataFrame) -> DataFrame:
    """indicators[] that each hold a series[]; unreadable dates and numbers are null."""
    m, s = F.col("m"), F.col("s")
    return (
        docs.select(
            F.get_json_object("doc", "$.source").alias("source"),
            F.explode(F.from_json(F.get_json_object("doc", "$.indicators"), OBJECTS)).alias("m"),
        )
        .select("source", "m", F.explode(F.from_json(m["series"], OBJECTS)).alias("s"))
        .select(
            m["code"].alias("indicator_code"),
            m["name"].alias("indicator_name"),
            m["category"].alias("category"),
            m["unit"].alias("unit"),
            F.try_to_date(s["date"], "yyyy-MM-dd").alias("indicator_date"),
            s["value"].try_cast("double").alias("value"),
            "source",
        )
    )


def holidays(docs: DataFrame, year: Column) -> DataFrame:
    """Holidays of the segments CM, FO and CD; unreadable dates are dropped."""
    per = [_segment(name) for name in ("CM", "FO", "CD")]
    return (
        docs.select(year.alias("y"), F.explode(F.concat(*per)).alias("h"))
        .select(F.col("h.segment").alias("segment"), parse_holiday(F.col("h.t"), F.col("y")).alias("holiday_date"), F.col("h.holiday_name").alias("holiday_name"))
        .filter("holiday_date IS NOT NULL")
    )


def _segment(name: str) -> Column:
    listed = F.coalesce(F.from_json(F.get_json_object("doc", f"$.{name}"), OBJECTS), F.array().cast(OBJECTS))
    return F.transform(
        listed,
        lambda x: F.struct(
            F.lit(name).alias("segment"),
            x["tradingDate"].alias("t"),
            F.coalesce(x["description"], F.lit("Holiday")).alias("holiday_name"),
        ),
    )


# Option fields of the feed and their canonical names.
OPTION_FIELDS = {
    "bidprice": "bid_price", "askPrice": "ask_price", "lastPrice": "last_price", "totalTradedVolume": "volume",
    "openInterest": "open_interest", "changeinOpenInterest": "change_in_oi", "impliedVolatility": "implied_volatility",
    "delta": "delta", "theta": "theta", "gamma": "gamma", "vega": "vega",
}


def option_chain(docs: DataFrame, underlying: Column, snapshot: Column) -> DataFrame:
    """One row per strike, expiry and option type present in the document."""
    m, o = F.col("m"), F.col("o")
    both = F.array(
        *[F.struct(F.lit(t).alias("option_type"), F.from_json(m[t], OBJECT).alias("o")) for t in ("CE", "PE")]
    )
    rows = docs.select(
        underlying.alias("underlying"),
        snapshot.alias("snapshot_time"),
        F.get_json_object("doc", "$.records.underlyingValue").cast("double").alias("underlying_value"),
        F.explode(F.from_json(F.get_json_object("doc", "$.records.data"), OBJECTS)).alias("m"),
    ).select("*", F.inline(F.filter(both, lambda x: x["o"].isNotNull())))
    expiry = m["expiryDate"]
    iso = F.coalesce(F.date_format(F.try_to_date(expiry, "d-MMM-yyyy"), "yyyy-MM-dd"), expiry)
    whole = ("volume", "open_interest", "change_in_oi")
    return rows.select(
        "underlying", "snapshot_time", "underlying_value",
        iso.alias("expiry_date"),
        m["strikePrice"].cast("double").alias("strike_price"),
        "option_type",
        *[(safe_long(o[k]) if v in whole else safe_double(o[k])).alias(v) for k, v in OPTION_FIELDS.items()],
    )


# Shareholding row captions and their fields; the first caption contained wins.
HOLDER_CAPTIONS = (
    ("promoter", "promoter_shareholding_percent"),
    ("public", "public_shareholding_percent"),
    ("institutional", "institutional_shareholding_percent"),
    ("fii", "fii_shareholding_percent"),
    ("dii", "dii_shareholding_percent"),
    ("mutual fund", "mutual_fund_shareholding_percent"),
    ("insurance", "insurance_companies_percent"),
    ("bank", "banks_shareholding_percent"),
    ("employee", "employee_shareholding_percent"),
)


# Character entities of HTML cells; the ampersand comes last, so that nothing is decoded twice.
ENTITIES = (("&nbsp;", " "), ("&#160;", " "), ("&#xa0;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&#37;", "%"), ("&percnt;", "%"), ("&amp;", "&"))


def shareholding_tables(docs: DataFrame) -> DataFrame:
    """One record per HTML document that has at least one holder row in a table; later rows win."""
    # innermost rows, however tables are nested: what follows a row's opening tag up to its end, without another opening tag
    opened = F.slice(F.split("doc", r"(?i)<tr\b[^>]*>"), 2, F.length("doc"))
    closed = F.filter(opened, lambda x: x.rlike(r"(?i)</tr\s*>"))
    inner = F.transform(closed, lambda x: F.split(x, r"(?i)</tr\s*>", 2)[0])
    rows = docs.filter(F.col("doc").rlike(r"(?i)<table\b")).select("doc_id", F.posexplode(inner).alias("pos", "tr"))
    cells = F.regexp_extract_all("tr", F.lit(r"(?is)<td\b[^>]*>(.*?)</td>"), 1)

    def text(cell: Column) -> Column:
        out = F.regexp_replace(cell, "<[^>]+>", "")
        for entity, plain in ENTITIES:
            out = F.replace(out, F.lit(entity), F.lit(plain))
        return F.trim(out)

    caption = F.lower(text(F.get("c", 0)))
    field = F.lit(None).cast("string")
    for word, name in reversed(HOLDER_CAPTIONS):
        field = F.when(caption.contains(word), name).otherwise(field)
    facts = (
        rows.withColumn("c", cells)
        .filter(F.size("c") >= 2)
        .select("doc_id", "pos", field.alias("field"), F.trim(F.replace(text(F.get("c", 1)), F.lit("%"), F.lit(""))).try_cast("double").alias("value"))
        .filter("field IS NOT NULL AND value IS NOT NULL")
    )
    return facts.groupBy("doc_id").agg(
        *[F.max_by(F.when(F.col("field") == n, F.col("value")), F.when(F.col("field") == n, F.col("pos"))).alias(n) for _, n in HOLDER_CAPTIONS]
    )


# Exact XBRL tag names and the financial field each one fills.
XBRL_TAGS = {
    "RevenueFromOperations": "revenue",
    "SegmentRevenueFromOperations": "revenue",
    "Income": "income",
    "OtherIncome": "other_income",
    "EmployeeBenefitExpense": "employee_benefit_expense",
    "FinanceCosts": "interest_expense",
    "SegmentFinanceCosts": "interest_expense",
    "DepreciationDepletionAndAmortisationExpense": "depreciation",
    "OtherExpenses": "other_expenses",
    "DescriptionOfOtherExpenses": "other_expenses_description",
    "Expenses": "expenses",
    "ProfitBeforeExceptionalItemsAndTax": "operating_profit",
    "ProfitBeforeTax": "profit_before_tax",
    "ProfitLossForPeriodFromContinuingOperations": "net_profit",
    "ProfitLossForPeriod": "net_profit",
    "ProfitOrLossAttributableToOwnersOfParent": "profit_or_loss_attributable_to_parent",
    "ProfitOrLossAttributableToNonControllingInterests": "profit_or_loss_attributable_to_non_controlling",
    "TaxExpense": "tax_expense",
    "CurrentTax": "current_tax",
    "DeferredTax": "deferred_tax",
    "NetMovementInRegulatoryDeferralAccountBalancesRelatedToProfitOrLossAndTheRelatedDeferredTaxMovement": "regulatory_deferral_movement",
    "PaidUpValueOfEquityShareCapital": "paid_up_value_of_equity_share_capital",
    "FaceValueOfEquityShareCapital": "face_value_of_equity_share_capital",
    "BasicEarningsLossPerShareFromContinuingOperations": "eps",
    "DilutedEarningsLossPerShareFromContinuingOperations": "diluted_eps",
    "BasicEarningsLossPerShareFromContinuingAndDiscontinuedOperations": "eps",
    "DilutedEarningsLossPerShareFromContinuingAndDiscontinuedOperations": "diluted_eps",
    "TotalAssets": "total_assets",
    "SegmentAssets": "total_assets",
    "TotalLiabilities": "total_liabilities",
    "SegmentLiabilities": "total_liabilities",
    "Equity": "equity",
    "TotalDebt": "total_debt",
    "CurrentAssets": "current_assets",
    "CurrentLiabilities": "current_liabilities",
    "CashAndCashEquivalents": "cash_and_equivalents",
    "Inventories": "inventories",
    "InterSegmentRevenue": "inter_segment_revenue",
    "SegmentProfitLossBeforeTaxAndFinanceCosts": "segment_profit_before_tax_and_finance_costs",
    "SegmentProfitBeforeTax": "segment_profit_before_tax",
    "OtherUnallocableExpenditureNetOffUnAllocableIncome": "other_unallocable_expenditure",
    "ComprehensiveIncomeForThePeriod": "comprehensive_income_for_the_period",
    "ComprehensiveIncomeForThePeriodAttributableToOwnersOfParent": "comprehensive_income_attributable_to_parent",
    "ComprehensiveIncomeForThePeriodAttributableToOwnersOfParentNonControllingInterests": "comprehensive_income_attributable_to_non_controlling",
    "SegmentRevenue": "segment_revenue",
}
XBRL_FIELDS = (
    "revenue", "operating_profit", "net_profit", "depreciation", "interest_expense", "tax_expense", "total_assets",
    "total_liabilities", "equity", "total_debt", "current_assets", "current_liabilities", "cash_and_equivalents",
    "inventories", "eps",
)
#: what is read off an XBRL document by name; everything else in it is a fact
XBRL_TYPE = (
    "context array<struct<_id string, entity struct<identifier struct<_VALUE string, _scheme string>>, period struct<endDate string>>>, "
    "unit array<struct<_id string, measure array<string>>>, _broken string"
)
XML_ATTRIBUTE = r"""\s+[^\s=<>/]+\s*=\s*(?:"[^"]*"|'[^']*')"""
#: an opening tag with attributes, and the text up to the next tag; possessive, so that long texts need no stack
XML_HEAD = rf"""(?s)<[^\s<>/!?]+(?:{XML_ATTRIBUTE})+\s*/?>"""
XML_ELEMENT = rf"""{XML_HEAD}[^<]*+(?:<!\[CDATA\[.*?\]\]>[^<]*+)*+"""


def _attribute(attributes: Column, name: str) -> Column:
    """Value of one attribute, null where it is absent or empty."""
    return F.nullif(F.regexp_extract(attributes, rf"""(?s)\s{name}\s*=\s*(["'])(.*?)\1""", 2), F.lit(""))


def _xml_text(raw: Column) -> Column:
    """Text of an element with references and CDATA sections resolved, trimmed, null where nothing is left."""
    read = F.when(raw.rlike("[&<]"), F.xpath_string(F.concat(F.lit("<a>"), raw, F.lit("</a>")), F.lit("/a"))).otherwise(raw)
    return F.nullif(F.regexp_replace(read, r"^\s+|\s+$", ""), F.lit(""))


def xbrl_facts(docs: DataFrame) -> DataFrame:
    """Long facts per document: ``doc_id``, ``pos`` (document order), ``tag``, ``unit``, ``decimals``, ``text``, ``entity``,
    ``period_end``, ``rounding`` and ``error``.

    Contexts and units are read by Spark's XML function, which also tells documents that are not well formed: these, and
    null ones, give one row with ``error`` and no fact.  A fact is any element that refers to a context, whatever its
    name and namespace, those inside tuples included; it has the text before its first child.  The last of several
    contexts or units with one id counts.
    """
    options = {"ignoreNamespace": "true", "columnNameOfCorruptRecord": "_broken"}
    # exploded, a document is parsed once: a condition on the result would else be pushed down with the parsing in it
    parsed = docs.select("doc_id", "doc", F.explode(F.array(F.from_xml("doc", XBRL_TYPE, options))).alias("x"))
    error = F.when(F.col("doc").isNull(), "no document").when(F.col("x").isNull() | F.col("x._broken").isNotNull(), "not a well-formed XML document")
    body = F.regexp_replace("doc", "(?s)<!--.*?-->", "")
    level = F.regexp_extract(body, r"<(?:[^\s<>/:]+:)?LevelOfRoundingUsedInFinancialStatements(?:\s[^<>]*[^<>/])?>([^<]+)<", 1)
    elements = F.filter(F.regexp_extract_all(body, F.lit(XML_ELEMENT), F.lit(0)), lambda e: e.contains("contextRef"))
    marked = parsed.withColumn("error", error).withColumn("rounding", F.nullif(level, F.lit("")))
    # one match gives the opening tag; name, attributes and text are cut off it
    cut = F.transform(elements, lambda e: F.struct(e.alias("element"), F.regexp_extract(e, XML_HEAD, 0).alias("head")))
    rows = marked.select("doc_id", "x", "error", "rounding", F.posexplode_outer(F.when(F.col("error").isNull(), cut)).alias("pos", "e"))
    tagged = rows.select("doc_id", "x", "error", "rounding", "pos", "e.element", "e.head")
    head = F.col("head")
    name = F.substring_index(F.regexp_extract(head, r"^<([^\s<>/!?]+)", 1), ":", -1)
    raw = F.when(~head.endswith("/>"), F.expr("substr(element, length(head) + 1)"))
    parts = tagged.select("doc_id", "x", "error", "rounding", "pos", name.alias("name"), raw.alias("raw"), *[_attribute(head, n).alias(n) for n in ("contextRef", "unitRef", "decimals")])
    refs = parts.filter(F.col("error").isNotNull() | F.col("contextRef").isNotNull())
    context = F.try_element_at(F.filter("x.context", lambda c: c["_id"] == F.col("contextRef")), F.lit(-1))
    unit = F.try_element_at(F.filter("x.unit", lambda u: u["_id"] == F.col("unitRef")), F.lit(-1))
    found = refs.withColumns({"c": context, "u": unit})
    return found.select(
        "doc_id",
        F.coalesce("pos", F.lit(-1)).alias("pos"),
        F.when(F.col("error").isNull(), F.col("name")).alias("tag"),
        F.when(F.col("u").isNotNull(), F.get(F.col("u.measure"), 0)).otherwise(F.col("unitRef")).alias("unit"),
        "decimals",
        _xml_text(F.col("raw")).alias("text"),
        F.col("c.entity.identifier._VALUE").alias("entity"),
        F.col("c.period.endDate").alias("period_end"),
        "rounding",
        "error",
    )


# Words of a tag outside the exact list, words it must not hold, and the field it may fill; the first that
# applies counts.  A profit that is neither before tax nor net fills nothing.
TAG_WORDS = (
    (("revenue",), (), "revenue"),
    (("profitbefore",), (), "operating_profit"),
    (("profit", "beforetax"), ("loss",), "operating_profit"),
    (("profit", "beforetax", "net"), (), "operating_profit"),
    (("profit", "net"), (), "net_profit"),
    (("profit", "forperiod"), ("loss",), "net_profit"),
    (("profit",), ("loss",), None),
    (("eps",), (), "eps"),
    (("earnings",), (), "eps"),
    (("asset",), (), "total_assets"),
    (("liabil",), (), "total_liabilities"),
    (("equity",), (), "equity"),
)


def _guess(tag: Column) -> Column:
    """Field a tag outside the exact list may fill, by keyword."""
    t = F.lower(tag)
    out = F.lit(None).cast("string")
    for words, without, field in reversed(TAG_WORDS):
        applies = reduce(lambda c, w: c & t.contains(w), words, F.lit(True))
        applies = reduce(lambda c, w: c & ~t.contains(w), without, applies)
        out = F.when(applies, field).otherwise(out)
    return out


def scaled_value() -> Column:
    """Fact value: negative decimals scale first, else the file's rounding unless per share or pure."""
    value = safe_double(F.col("text"), ("", "-", "nan"))
    digits = F.col("decimals").try_cast("int")
    unit = F.lower(F.coalesce("unit", F.lit("")))
    monetary = ~unit.contains("share") & ~unit.contains("pure")
    level = F.lower(F.coalesce("rounding", F.lit("")))
    divisor = F.when(level.contains("crore"), 1e7).when(level.contains("lakh"), 1e5).when(level.contains("thousand"), 1e3).otherwise(1.0)
    return F.when(digits < 0, value / F.pow(F.lit(10.0), -digits)).when(monetary, value / divisor).otherwise(value)


def xbrl_records(facts: DataFrame) -> DataFrame:
    """One record per document: the last exact fact wins, a guess only fills an empty field.

    Facts that map to nothing go to ``metadata`` under their tag, repeats with a running suffix.
    """
    from pyspark.sql import Window

    tags = F.create_map(*[F.lit(x) for pair in XBRL_TAGS.items() for x in pair])
    guarded = ("revenue", "total_assets", "total_liabilities", "equity")
    rows = facts.filter("error IS NULL").withColumns(
        {"exact": tags[F.col("tag")], "value": scaled_value()}
    ).withColumn("field", F.coalesce("exact", _guess(F.col("tag"))))
    # facts of one filing are few, so these windows are small whatever the number of filings
    before = Window.partitionBy("doc_id", "field").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    is_exact = F.col("exact").isNotNull()
    last_exact = F.last(F.when(is_exact, F.struct("pos", "value")), ignorenulls=True).over(before)
    last_guess = F.max(F.when(~is_exact & F.col("value").isNotNull(), F.col("pos"))).over(before)
    rows = rows.withColumns({"_e": last_exact, "_g": last_guess})
    filled = F.coalesce(F.col("_e.value").isNotNull(), F.lit(False)) | F.coalesce(
        F.col("_g") > F.coalesce(F.col("_e.pos"), F.lit(-1)), F.lit(False)
    )
    used = F.col("field").isNotNull() & (is_exact | ~F.col("field").isin(*guarded) | ~filled)
    rows = rows.withColumn("used", used)

    def pick(name: str) -> Column:
        mine = F.col("used") & (F.col("field") == name)
        return F.max_by(F.when(mine, F.col("value")), F.when(mine, F.col("pos"))).alias(name)

    extra = F.sort_array(F.collect_list(F.when(~F.col("used"), F.struct("pos", F.col("tag").alias("k"), F.coalesce("text", F.lit("")).alias("v")))))

    def add(known: Column, fact: Column) -> Column:
        # the tag itself or the first suffix that is free
        suffixed = F.transform(F.sequence(F.lit(1), F.size(known) + 1), lambda i: F.concat_ws("_", fact["k"], i.cast("string")))
        free = F.filter(suffixed, lambda k: ~F.map_contains_key(known, k))
        name = F.when(F.map_contains_key(known, fact["k"]), free[0]).otherwise(fact["k"])
        return F.map_concat(known, F.create_map(name, fact["v"]))

    first_owner = F.min_by("entity", F.when(F.col("entity").isNotNull(), F.col("pos")))
    first_end = F.min_by("period_end", F.when(F.col("period_end").isNotNull(), F.col("pos")))
    return rows.groupBy("doc_id").agg(
        first_owner.alias("entity_id"),
        F.try_to_date(first_end, "yyyy-MM-dd").alias("period_end_date"),
        *[pick(f) for f in XBRL_FIELDS],
        F.aggregate(extra, F.create_map().cast("map<string,string>"), add).alias("metadata"),
    ).withColumn("symbol", last_segment(F.col("entity_id")))

