import gzip
import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ticklake import schemas
from ticklake.functions import finance
from ticklake.functions.envelope import flatten, nest, uuid5
from ticklake.functions.text import parse_date, parse_holiday, safe_double, safe_long
from ticklake.operators.dedupe import first_nonempty, prefer_first_source
from ticklake.quality.shape import SchemaMismatch
from ticklake.sources import documents as docs
from ticklake.sources import feeds
from ticklake.sources.instruments import enrich_instruments


def price_csv(tmp_path, lines, header=None):
    folder = tmp_path / "feed"
    folder.mkdir()
    (folder / "a.csv").write_text("\n".join([header or ",".join(schemas.PRICE_FEED), *lines]) + "\n")
    return str(folder)


def price_line(**cells):
    return ",".join(str(cells.get(c, "")) for c in schemas.PRICE_FEED)


def test_price_feed_nulls_and_blank_symbols(spark, tmp_path):
    path = price_csv(tmp_path, [price_line(TckrSymb="A", ClsPric="10.5", LastPric="-", SttlmPric="N/A", TtlTradgVol=7), price_line(ClsPric=1)])
    rows = feeds.read_prices(spark, path).collect()
    assert len(rows) == 1
    assert (rows[0]["ClsPric"], rows[0]["LastPric"], rows[0]["SttlmPric"], rows[0]["TtlTradgVol"]) == (10.5, None, None, 7)


def test_price_feed_strict_and_lenient(spark, tmp_path):
    path = price_csv(tmp_path, [price_line(TckrSymb="A", ClsPric="ten")])
    with pytest.raises(PySparkException):
        feeds.read_prices(spark, path).collect()
    row = feeds.read_prices(spark, path, strict=False).first()
    assert row["ClsPric"] is None and row["FinInstrmId"] == "0"


def test_price_feed_columns_must_match(spark, tmp_path):
    header = ",".join([*list(schemas.PRICE_FEED)[1:], "Odd"])
    with pytest.raises(SchemaMismatch, match="TradDt.*Odd"):
        feeds.read_prices(spark, price_csv(tmp_path, [], header))


def test_price_feed_ignores_nameless_trailing_column(spark, tmp_path):
    path = price_csv(tmp_path, [price_line(TckrSymb="A", ClsPric=1) + ","], ",".join(schemas.PRICE_FEED) + ",")
    assert feeds.read_prices(spark, path).count() == 1


def test_normalise_keeps_positive_closes(spark, tmp_path):
    path = price_csv(tmp_path, [price_line(TckrSymb=s, ClsPric=c, TradDt="2024-01-15", FinInstrmId=1) for s, c in (("A", 5), ("B", 0), ("C", ""))])
    out = feeds.normalize_prices(feeds.price_events(feeds.read_prices(spark, path), "nse_cm_bhavcopy", "NSE", "2024-01-15 18:00:00")).collect()
    assert [r["instrument_id"] for r in out] == ["A:NSE"]
    assert out[0]["event_id"] == str(uuid.uuid5(uuid.NAMESPACE_DNS, "nse_cm_bhavcopy:2024-01-15:A:1"))
    assert out[0]["entity_id"] == "A:1:NSE"


def test_uuid5_equals_the_standard_library(spark):
    names = ["", "a", "héllo", "x" * 300]
    got = spark.createDataFrame([(n,) for n in names], "n string").select(uuid5(F.col("n"))).collect()
    assert [r[0] for r in got] == [str(uuid.uuid5(uuid.NAMESPACE_DNS, n)) for n in names]


@pytest.mark.parametrize("text,day", [("26-Jan-2026", "2026-01-26"), ("26-JAN-2026", "2026-01-26"), ("1-2-2026", "2026-02-01"), ("2026-02-01", "2026-02-01"), ("31/12/2025", "2025-12-31"), ("-", None), ("30-Feb-2026", None), ("soon", None)])
def test_dates(spark, text, day):
    got = spark.createDataFrame([(text,)], "t string").select(parse_date(F.col("t"))).first()[0]
    assert (str(got) if got else None) == day


@pytest.mark.parametrize("text,day", [("26-Jan", "2026-01-26"), ("26-January", "2026-01-26"), ("26/01", "2026-01-26"), ("26-01", "2026-01-26"), ("2025-01-26", "2025-01-26")])
def test_holidays_without_year(spark, text, day):
    got = spark.createDataFrame([(text, 2026)], "t string, y int").select(parse_holiday(F.col("t"), F.col("y"))).first()[0]
    assert str(got) == day


def test_numbers(spark):
    df = spark.createDataFrame([("1,234.5",), (" - ",), ("NA",), ("12x",), ("7",)], "t string")
    assert [r[0] for r in df.select(safe_double(F.col("t"))).collect()] == [1234.5, None, None, None, 7.0]
    assert [r[0] for r in df.select(safe_long(F.col("t"))).collect()] == [1234, None, None, None, 7]


def documents(spark, *texts):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "doc_id string, doc string")


def test_action_documents_accept_lists_and_wrappers(spark):
    d = documents(
        spark, '[{"symbol":"A","exDate":"16-Oct-2025","subject":"Bonus 1:1"}]', '{"result":[{"symbol":"B","ex_date":"2025-10-16","purpose":"AGM"}]}',
        '{"data":[{"symbol":"C","EX-DATE":"nonsense"}]}', "{broken", "[]",
    )
    assert {r["symbol"] for r in docs.corporate_actions(d).collect()} == {"A", "B"}
    assert [r["doc_id"] for r in docs.document_errors(d).collect()] == ["3"]


def test_deals_skip_empty_sides(spark):
    d = documents(spark, '[{"symbol":"A","clientName":"X","buyQty":5,"sellQty":0,"buyAvgPrice":2.5},{"SYMBOL":"B","SellQty":"1,000","SellAvgPrice":3}]')
    got = {(r["symbol"], r["transaction_type"], r["quantity"], r["avg_price"]) for r in docs.deals(d, F.lit("BULK")).collect()}
    assert got == {("A", "BUY", 5, 2.5), ("B", "SELL", 1000, 3.0)}


def test_constituents_weight_and_series(spark):
    d = documents(spark, '{"data":[{"symbol":" A ","series":"EQ","meta":{"isin":"I1"},"isin":"I2","indexWeight":"2.5","weightage":9},{"symbol":"B","series":"BE","weightage":4},{"symbol":"C","series":"GB"},{"symbol":"","series":"EQ"}]}')
    got = docs.constituents(d, F.lit("NIFTY50"), F.lit("2024-01-01").cast("date"), F.lit("ADD")).collect()
    assert {(r["symbol"], r["isin"], r["weight"], r["index_category"]) for r in got} == {("A", "I1", 2.5, "Broad Market"), ("B", None, 4.0, "Broad Market")}


def test_option_chain_keeps_unreadable_expiry_text(spark):
    d = documents(spark, '{"records":{"underlyingValue":101.5,"data":[{"expiryDate":"25-Jan-2024","strikePrice":100,"CE":{"lastPrice":1.5,"openInterest":7}},{"expiryDate":"weekly","strikePrice":90,"PE":{"delta":-0.5}}]}}')
    got = docs.option_chain(d, F.lit("N"), F.lit("2024-01-01").cast("timestamp")).collect()
    assert {(r["expiry_date"], r["option_type"], r["last_price"], r["delta"]) for r in got} == {("2024-01-25", "CE", 1.5, None), ("weekly", "PE", None, -0.5)}


def test_shareholding_first_caption_and_last_row_win(spark):
    html = "<table><tr><td>Promoter and public</td><td>60.5 %</td></tr><tr><td><b>Promoter</b></td><td>55%</td></tr><tr><td>only one</td></tr><tr><td>FII</td><td>x</td></tr></table>"
    rows = docs.shareholding_tables(documents(spark, html, "<p>Promoter 10%</p>")).collect()
    assert len(rows) == 1
    assert rows[0]["promoter_shareholding_percent"] == 55.0 and rows[0]["public_shareholding_percent"] is None and rows[0]["fii_shareholding_percent"] is None


NS = "xmlns='http://www.xbrl.org/2003/instance' xmlns:i='urn:i'"


def xbrl(*facts, rounding="Crores"):
    return (
        f"<xbrl {NS}><context id='c'><entity><identifier>http://e/ACME</identifier></entity><period><endDate>2024-03-31</endDate></period></context>"
        f"<unit id='inr'><measure>iso4217:INR</measure></unit><unit id='ps'><measure>INR/shares</measure></unit>"
        f"<i:LevelOfRoundingUsedInFinancialStatements contextRef='c'>{rounding}</i:LevelOfRoundingUsedInFinancialStatements>{''.join(facts)}</xbrl>"
    )


def fact(tag, value, more="unitRef='inr'"):
    return f"<i:{tag} contextRef='c' {more}>{value}</i:{tag}>"


def test_xbrl_scaling_guards_and_metadata(spark):
    doc = xbrl(
        fact("NetRevenueGuess", "50000000"), fact("RevenueFromOperations", "20000000"), fact("OtherRevenueLine", "70000000"),
        fact("BasicEarningsLossPerShareFromContinuingOperations", "3.5", "unitRef='ps'"), fact("TotalAssets", "4000", "unitRef='inr' decimals='-3'"),
        fact("NetProfitForPeriodGuess", "10000000"), fact("Note", "abc"), fact("Note", "def"),
    )
    d = documents(spark, doc, "<xbrl")
    facts = docs.xbrl_facts(d)
    assert facts.filter("error is not null").count() == 1
    r = docs.xbrl_records(facts).first()
    assert (r["symbol"], str(r["period_end_date"]), r["revenue"], r["eps"], r["total_assets"], r["net_profit"]) == ("ACME", "2024-03-31", 2.0, 3.5, 4.0, 1.0)
    assert r["metadata"] == {"LevelOfRoundingUsedInFinancialStatements": "Crores", "OtherRevenueLine": "70000000", "Note": "abc", "Note_1": "def"}


def test_xbrl_guess_fills_an_empty_field(spark):
    r = docs.xbrl_records(docs.xbrl_facts(documents(spark, xbrl(fact("SomeRevenue", "5"), fact("MoreRevenue", "6"), rounding="Actual")))).first()
    assert r["revenue"] == 5.0 and r["metadata"]["MoreRevenue"] == "6"


def test_xbrl_facts_of_odd_documents(spark):
    """Comments, CDATA, references, self-closed facts, prefixes and quotes; broken, null and empty documents; repeated ids."""
    odd = (
        "<?xml version='1.0'?><x:xbrl xmlns:x='http://www.xbrl.org/2003/instance' xmlns:i='urn:i'><!-- <i:Gone contextRef='c'>1</i:Gone> -->"
        "<x:context id='c'><x:entity><x:identifier scheme='s'>http://e/OLD</x:identifier></x:entity><x:period><x:endDate>2023-03-31</x:endDate></x:period></x:context>"
        '<x:context id="c"><x:entity><x:identifier scheme="s">http://e/NEW</x:identifier></x:entity><x:period><x:endDate>2024-03-31</x:endDate></x:period></x:context>'
        "<x:unit id='u'><x:measure>iso4217:INR</x:measure></x:unit>"
        """<i:A decimals="-3"\n contextRef = "c" unitRef='u'> 5<!-- five -->0 </i:A><i:B contextRef='c'/><i:C contextRef='c' unitRef='none'>a &lt;b&gt; &#233; &amp;amp;</i:C>"""
        f"<i:D contextRef='c' note='1 > 0'><![CDATA[x < y & z]]></i:D><i:E contextRef='gone'>{'long ' * 50000}</i:E><i:F>no context</i:F></x:xbrl>"
    )
    d = spark.createDataFrame([("odd", odd), ("none", None), ("empty", ""), ("bad", "<xbrl><Income contextRef='c'>5</xbrl>"), ("bare", "<xbrl/>")], "doc_id string, doc string")
    rows = docs.xbrl_facts(d).orderBy("doc_id", "pos").collect()
    assert [(r["doc_id"], r["pos"], r["tag"], r["error"] is None) for r in rows if r["doc_id"] != "odd"] == [(n, -1, None, False) for n in ("bad", "empty", "none")]
    got = {r["tag"]: (r["unit"], r["decimals"], r["text"], r["entity"], r["period_end"]) for r in rows if r["doc_id"] == "odd"}
    new = ("http://e/NEW", "2024-03-31")
    assert got == {
        "A": ("iso4217:INR", "-3", "50", *new), "B": (None, None, None, *new), "C": ("none", None, "a <b> \u00e9 &amp;", *new),
        "D": (None, None, "x < y & z", *new), "E": (None, None, ("long " * 50000).strip(), None, None),
    }


def test_xbrl_is_read_without_python(spark):
    d = documents(spark, xbrl(fact("Equity", "5")))
    plan = docs.xbrl_records(docs.xbrl_facts(d))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_profit_words_of_tags(spark):
    tags = {
        "ProfitBeforeTaxOther": "operating_profit", "ProfitLossBeforeTax": "eps_none", "NetProfitLossBeforeTax": "operating_profit", "NetProfitLossX": "net_profit",
        "ProfitForPeriodX": "net_profit", "ProfitLossForPeriodX": "eps_none", "ProfitAssets": "none", "ProfitLossAssets": "total_assets", "ReportedEPS": "eps", "Earnings": "eps",
        "OtherLiabilities": "total_liabilities", "OtherEquity": "equity", "Word": "none",
    }
    rows = spark.createDataFrame([(t,) for t in tags], "tag string").select("tag", docs._guess(F.col("tag")).alias("field")).collect()
    assert {r["tag"]: r["field"] for r in rows} == {t: None if f.endswith("none") else f for t, f in tags.items()}


def test_deal_spellings_nulls_and_broken_documents(spark):
    listed = '[{"symbol": "", "Symbol": " A ", "ClientName": "c", "buyQty": "1,000", "BuyQty": 7, "buyAvgPrice": 2.50, "DealDate": "05-JAN-2024"}, {"SYMBOL": "B", "SellQty": 3}, {"buyQty": 4}, {}]'
    d = documents(spark, listed, "{oops", "[]", None).withColumn("symbol", F.lit("other"))
    rows = docs.deals(d, F.lit("BULK")).collect()
    assert [(r["symbol"], r["client_name"], str(r["deal_date"]), r["transaction_type"], r["quantity"], r["avg_price"]) for r in rows] == [
        ("A", "c", "2024-01-05", "BUY", 1000, 2.5), ("B", None, "None", "SELL", 3, None),
    ]


def test_documents_are_read_per_file(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"symbol":"A",\n"exDate":"16-Oct-2025"}]')
    (tmp_path / "b.json").write_text("{nope")
    d = docs.read_documents(spark, str(tmp_path))
    assert d.count() == 2 and docs.corporate_actions(d).count() == 1 and docs.document_errors(d).count() == 1


def test_a_batch_of_files_keeps_the_failures_apart(spark, tmp_path):
    files = {
        "a/list.json": '[{"symbol": "A"}, {"symbol": "B"}]', "a/b/object.json": '\ufeff {"result": [{"symbol": "C"}]}', "bad.json": '{"data": [', "none.json": "{}",
        "ok.xml": '<xbrl xmlns="x"><context id="c"/><Income contextRef="c">5</Income></xbrl>', "bad.xml": "<?xml version='1.0'?><a><b></a>", "empty.txt": " \n", "x.bin": "what is this",
        "t.html": "<table><tr><td>Promoter</td><td>5</td></tr></table>", "u.html": "<table></table>",
    }
    for name, text in files.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    out = docs.batch_outcomes(docs.read_documents(spark, str(tmp_path))).collect()
    got = {r["doc_id"].rsplit("/", 1)[1]: (r["format"], r["records"], r["error"] is None) for r in out}
    assert len(out) == len(files) and got == {
        "list.json": ("json", 2, True), "object.json": ("json", 1, True), "bad.json": ("json", 0, False), "none.json": ("json", 0, True), "ok.xml": ("xml", 1, True), "bad.xml": ("xml", 0, False),
        "empty.txt": ("empty", 0, False), "x.bin": ("unknown", 0, False), "t.html": ("html", 1, True), "u.html": ("html", 0, False),
    }


def test_headers_are_read_without_a_scan(spark, tmp_path):
    """Files of two column orders, one of them packed, a name with a blank, and an empty one: no job runs before the read."""
    (tmp_path / "a 1.csv").write_text("x, y \n1,2\n")
    (tmp_path / "c.csv").write_text("")
    with gzip.open(tmp_path / "b.csv.gz", "wt") as f:
        f.write(" y,x\n4,3\n")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    df = feeds._header_groups(spark, str(tmp_path))
    assert list(tracker.getJobIdsForGroup("headers")) == [] and [len(g) for g in df] == [1, 1]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted((r["x"], r["y"]) for r in feeds.read_text_csv(spark, str(tmp_path)).collect()) == [("1", "2"), ("3", "4")]


def test_screens_take_their_limits(spark):
    rows = spark.createDataFrame([("a", 20.0, 0.5, 12.0, 60.0, 10.0, 150.0), ("b", 20.0, 0.5, 5.0, 60.0, 10.0, 250.0), ("c", None, 0.5, 50.0, 60.0, 10.0, 1.0)], "symbol string, roe double, debt_to_equity double, net_margin double, promoter double, eps double, close double")
    names = lambda df: [r["symbol"] for r in df.collect()]
    assert names(finance.strong_fundamentals(rows)) == ["a"] and names(finance.strong_fundamentals(rows, net_margin=4.0)) == ["a", "b"]
    assert names(finance.undervalued(rows)) == ["a"] and names(finance.undervalued(rows, pe=30.0)) == ["a", "b"]


def test_deal_feed_spellings(spark, tmp_path):
    (tmp_path / "d.csv").write_text('SYMBOL,CLIENT_NAME,BUY_SELL,QTY,PRICE\nA,X,buy,"1,500",10.5\nB,Y,,5,1\n,Z,SELL,5,1\nC,W,SELL,zero,1\n')
    got = feeds.read_deals(spark, str(tmp_path), "BULK").collect()
    assert [(r["symbol"], r["transaction_type"], r["quantity"], r["avg_price"]) for r in got] == [("A", "BUY", 1500, 10.5)]


def test_enrichment_fans_out_and_falls_back(spark):
    rows = spark.createDataFrame([("A", "I1"), ("B", "I9"), ("C", None)], "symbol string, isin string")
    master = spark.createDataFrame([("A", "I1", "a1"), ("A", "I2", "a2"), ("B", "I3", "b1"), ("B", "I4", "b2")], "symbol string, isin string, name string")
    got = sorted((r["symbol"], r["name"] or "") for r in enrich_instruments(rows, master, ["name"]).collect())
    assert got == [("A", "a1"), ("B", "b1"), ("B", "b2"), ("C", "")]


def test_source_preference_and_fallback(spark):
    a = spark.createDataFrame([("I1", "a")], "isin string, s string")
    b = spark.createDataFrame([("I1", "b"), (None, "b"), ("I2", "b")], "isin string, s string")
    assert sorted((r["isin"] or "", r["s"]) for r in prefer_first_source(a, b, "isin").collect()) == [("", "b"), ("I1", "a"), ("I2", "b")]
    assert prefer_first_source(None, b, "isin") is b
    with pytest.raises(ValueError):
        prefer_first_source(None, None, "isin")
    assert [r["s"] for r in first_nonempty([a.limit(0), a, b]).collect()] == ["a"]


def test_nest_then_flatten(spark):
    df = spark.createDataFrame([("e", "x", 1)], "event_id string, symbol string, n int")
    assert nest(df).columns == ["event_id", "payload"]
    assert flatten(nest(df)).collect() == df.collect() and flatten(df) is df


def test_null_keys_count_as_duplicates(spark):
    from ticklake.operators.dedupe import duplicate_members

    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    assert sorted(r["v"] for r in duplicate_members(df, ["k"]).collect()) == [1, 2]


@pytest.mark.parametrize("tokens", [("-", "", "null"), ("", "-", "nan"), ("-", "null", "")])
def test_missing_tokens_wherever_they_are_listed(spark, tokens):
    from ticklake.functions.text import clean

    texts = ["-", "", "  ", " null ", "nan", "a", "a,b", "-,", ",", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(clean(F.col("t"), tokens)).collect()
    want = [None if t is None or t.strip(" ") in tokens else t.strip(" ") for t in texts]
    assert [r[0] for r in got] == want


def test_documents_of_a_folder_are_opened_once(spark, tmp_path):
    """Every format has its own reader, but none of them goes back to the files."""
    for i, text in enumerate(['[{"symbol": "A"}]', "<?xml version='1.0'?><xbrl/>", "<html><p>x</p></html>", "\n", "plain"]):
        (tmp_path / f"{i}.txt").write_text(text)
    out = docs.batch_outcomes(docs.read_documents(spark, str(tmp_path)))
    assert "Scan text" not in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["format"] for r in out.collect()) == ["empty", "html", "json", "unknown", "xml"]


def test_xbrl_documents_are_parsed_once(spark):
    d = documents(spark, xbrl(fact("Equity", "5")))
    plan = docs.xbrl_records(docs.xbrl_facts(d))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml(") == 1
