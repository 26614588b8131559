"""STR: streaming operators replayed over the event table and compared with their batch meaning."""

from pyspark.sql import functions as F

from ticklake.bridge import with_sql
from ticklake.functions.rounding import r2, r4, sql2, sql4
from ticklake.plans.registry import query
from ticklake.plans.windows import ema_fold_sql
from ticklake.quality import rules
from ticklake.session import fresh_path
from ticklake.streaming import engine, envelopes, state
from ticklake.streaming import operators as ops

CUT = "2024-01-20 00:00:00"


def tick_stream(m):
    """The event table as a stream."""
    schema = m.table("events").schema
    return engine.ticks_from_events(engine.read_stream(m.spark, m.dir, schema, "events.parquet"))


def ntz(*cols):
    return {c: F.col(c).cast("timestamp_ntz") for c in cols}


class Phases:
    """A topic folder fed in phases, each followed by a run over what is new."""

    def __init__(self, m, label):
        self.spark = m.spark
        self.base = fresh_path(m.spark, label)

    def feed(self, rows):
        rows.write.mode("append").parquet(f"{self.base}/topic")

    def stream(self):
        return engine.read_stream(self.spark, f"{self.base}/topic", engine.TICK_SCHEMA)


WM = "(SELECT max(ts) FROM ticks)"


def hourly_sql(cond: str) -> str:
    return f"""SELECT date_trunc('hour', ts) AS window_start, kind, {sql4("arg_min(price, row(ts, event_id))")} AS open, {sql4("max(price)")} AS high, {sql4("min(price)")} AS low,
 {sql4("arg_max(price, row(ts, event_id))")} AS close, count(*) AS n FROM ticks GROUP BY 1, 2 HAVING {cond}"""


CLOSED = f"date_trunc('hour', ts) + INTERVAL 1 HOUR <= {WM} - INTERVAL 30 MINUTE"


@query("src24_event_stream", with_sql("ticks", body=f"SELECT kind AS entity_id, count(*) AS n, {sql2('sum(price)')} AS total FROM ticks GROUP BY 1"))
def _(m):
    """Messages keyed by entity with a JSON value, as a topic delivers them."""
    value = F.to_json(F.struct("event_id", "ts", "price"))
    messages = tick_stream(m).select(F.col("kind").cast("binary").alias("key"), value.cast("binary").alias("value"))
    rows = engine.from_topic(messages, "event_id bigint, ts timestamp, price double")
    base = fresh_path(m.spark, "topic")
    engine.run_to_folder(rows, base)
    return engine.output(m.spark, base, rows).groupBy("entity_id").agg(F.count("*").alias("n"), r2(F.sum("price")).alias("total"))


LATENESS = {"purchase": 5400, "signup": 600}
OTHERS_LATE = 1800
DELAYS = {"purchase": "5400 seconds", "signup": "600 seconds", "click": "1800 seconds", "error": "1800 seconds", "view": "1800 seconds"}
ALLOWED = "INTERVAL 1 SECOND * CASE kind WHEN 'purchase' THEN 5400 WHEN 'signup' THEN 600 ELSE 1800 END"


@query(
    "str01_watermark_late_drop",
    with_sql("ticks", body=f""", again AS (SELECT kind, ts FROM ticks WHERE ts < TIMESTAMP '2024-01-02 00:00:00' OR (ts >= TIMESTAMP '{CUT}' - INTERVAL 6 HOUR AND ts < TIMESTAMP '{CUT}')),
 marks AS (SELECT kind, max(ts) - {ALLOWED} AS lim FROM ticks WHERE ts < TIMESTAMP '{CUT}' GROUP BY kind),
 placed AS (SELECT kind, ts, ts < lim AS late FROM again JOIN marks USING (kind)),
 kept AS (SELECT kind, ts FROM ticks UNION ALL SELECT kind, ts FROM placed WHERE NOT late),
 wm AS (SELECT min(m) AS wm FROM (SELECT max(ts) - {ALLOWED} AS m FROM kept GROUP BY kind)),
 w AS (SELECT kind, count(*) AS windows, CAST(sum(n) AS BIGINT) AS counted FROM (SELECT kind, date_trunc('hour', ts) AS h, count(*) AS n FROM kept GROUP BY 1, 2), wm WHERE h + INTERVAL 1 HOUR <= wm GROUP BY 1),
 l AS (SELECT kind, CAST(count_if(late) AS BIGINT) AS late_rows, CAST(count_if(NOT late) AS BIGINT) AS tolerated FROM placed GROUP BY 1)
 SELECT kind, windows, counted, late_rows, tolerated FROM w LEFT JOIN l USING (kind)"""),
)
def _(m):
    """Rows that come again after later ones: each kind tolerates another lateness, and what is later is stored.

    The kept rows are counted in hourly windows under one watermark a kind; the slowest of them closes a window.
    """
    phases = Phases(m, "late")
    step = state.lateness_step("kind", "ts", LATENESS, phases.base, OTHERS_LATE)

    def kept():
        return engine.read_stream(m.spark, f"{phases.base}/kept/*", engine.TICK_SCHEMA)

    def run():
        engine.run_batches(phases.stream(), phases.base, step)
        candles = ops.tumbling_candles(state.by_topic(kept(), "kind", "ts", DELAYS), "ts", "1 hour", None, ["kind"])
        engine.run_to_folder(candles, f"{phases.base}/windows", policy="min")
        return candles

    cut = F.lit(CUT).cast("timestamp")
    phases.feed(m.ticks.filter(F.col("ts") < cut))
    run()
    again = m.ticks.filter((F.col("ts") < F.lit("2024-01-02").cast("timestamp")) | ((F.col("ts") >= cut - F.expr("INTERVAL 6 HOURS")) & (F.col("ts") < cut)))
    again = again.withColumn("event_id", -F.col("event_id") - 1)
    phases.feed(m.ticks.filter(F.col("ts") >= cut).unionByName(again))
    candles = run()
    windows = engine.output(m.spark, f"{phases.base}/windows", candles).groupBy("kind").agg(F.count("*").alias("windows"), F.sum("n").alias("counted"))
    late = m.spark.read.schema(engine.TICK_SCHEMA).parquet(f"{phases.base}/late").select("kind", F.lit(1).alias("late"))
    tolerated = m.spark.read.schema(engine.TICK_SCHEMA).parquet(f"{phases.base}/kept").filter("event_id < 0").select("kind", F.lit(0).alias("late"))
    per_kind = late.unionByName(tolerated).groupBy("kind").agg(F.count_if(F.col("late") == 1).alias("late_rows"), F.count_if(F.col("late") == 0).alias("tolerated"))
    return windows.join(per_kind, "kind", "left").select("kind", "windows", "counted", "late_rows", "tolerated")


@query("str02_dedupe_by_event_id", with_sql("ticks", body="SELECT kind, count(*) AS n, count(DISTINCT event_id) AS ids FROM ticks GROUP BY 1"))
def _(m):
    base = fresh_path(m.spark, "dedupe")
    again = tick_stream(m).filter("event_id % 10 = 0")
    unique = ops.dedupe(tick_stream(m).unionByName(again), "event_id", "ts", "1 hour")
    engine.run_to_folder(unique, base)
    return engine.output(m.spark, base, unique).groupBy("kind").agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("ids"))


@query("str03_stream_quality_split", with_sql("ticks", body="SELECT CASE WHEN price < 5 OR kind = 'error' THEN 'quarantined' ELSE 'good' END AS place, count(*) AS n FROM ticks GROUP BY 1"))
def _(m):
    base = fresh_path(m.spark, "split")

    def checks(df):
        return [
            rules.Check("small_price", "critical", "price", F.col("price") < 5, F.lit("small")),
            rules.Check("error_event", "warning", "kind", F.col("kind") == "error", F.lit("error")),
        ]

    engine.run_batches(tick_stream(m), base, ops.split_step(checks, f"{base}/good", f"{base}/bad", "ticks", CUT))
    good = m.spark.read.parquet(f"{base}/good").select(F.lit("good").alias("place"))
    bad = m.spark.read.parquet(f"{base}/bad").select(F.lit("quarantined").alias("place"))
    return good.unionByName(bad).groupBy("place").agg(F.count("*").alias("n"))


@query("str04_tumbling_candles", with_sql("ticks", body=hourly_sql(f"date_trunc('hour', max(ts)) + INTERVAL 1 HOUR <= {WM} - INTERVAL 30 MINUTE")))
def _(m):
    base = fresh_path(m.spark, "candles")
    candles = ops.tumbling_candles(tick_stream(m), "ts", "1 hour", "30 minutes", ["kind"])
    engine.run_to_folder(candles, base)
    out = engine.output(m.spark, base, candles).drop("window_end")
    return out.withColumns({c: r4(c) for c in ("open", "high", "low", "close")}).withColumns(ntz("window_start"))


@query(
    "str05_sliding_windows",
    with_sql("ticks", body=f"""SELECT s AS window_start, kind, count(*) AS n, {sql4("sum(price)")} AS total FROM (SELECT kind, price, time_bucket(INTERVAL 15 MINUTE, ts) - k * INTERVAL 15 MINUTE AS s FROM ticks, (VALUES (0), (1), (2), (3)) v(k))
 GROUP BY 1, 2 HAVING s + INTERVAL 1 HOUR <= {WM} - INTERVAL 30 MINUTE"""),
)
def _(m):
    base = fresh_path(m.spark, "sliding")
    counts = ops.sliding_counts(tick_stream(m), "ts", "1 hour", "15 minutes", "30 minutes", ["kind"])
    engine.run_to_folder(counts, base)
    return engine.output(m.spark, base, counts).withColumn("total", r4("total")).withColumns(ntz("window_start"))


@query(
    "str06_session_windows",
    with_sql("ticks", body=f""", g AS (SELECT entity, ts, CASE WHEN ts > lag(ts) OVER w + INTERVAL 2 HOUR OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS new FROM ticks WINDOW w AS (PARTITION BY entity ORDER BY ts, event_id)),
 s AS (SELECT entity, ts, sum(new) OVER (PARTITION BY entity ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g)
 SELECT entity, min(ts) AS session_start, max(ts) + INTERVAL 2 HOUR AS session_end, count(*) AS n FROM s GROUP BY entity, sid HAVING max(ts) + INTERVAL 2 HOUR <= {WM} - INTERVAL 30 MINUTE"""),
)
def _(m):
    base = fresh_path(m.spark, "sessions")
    found = ops.sessions(tick_stream(m), "ts", "2 hours", "30 minutes", ["entity"])
    engine.run_to_folder(found, base)
    return engine.output(m.spark, base, found).withColumns(ntz("session_start", "session_end"))


EG = """, d AS (SELECT *, price - lag(price) OVER (PARTITION BY entity ORDER BY ts, event_id) AS diff FROM ticks),
 gl AS (SELECT *, greatest(coalesce(diff, 0), 0) AS gain, greatest(coalesce(-diff, 0), 0) AS loss FROM d)"""


@query(
    "str07_stateful_momentum",
    with_sql("ticks", body=f"""{EG}, e AS (SELECT event_id, entity, ts, {ema_fold_sql("price", 12, "gl", by="entity", order="ts, event_id")} AS e,
   {ema_fold_sql("gain", 14, "gl", by="entity", order="ts, event_id")} AS g, {ema_fold_sql("loss", 14, "gl", by="entity", order="ts, event_id")} AS l FROM gl),
 kn AS (SELECT DISTINCT entity FROM ticks WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '{CUT}')
 SELECT event_id, entity, {sql4("e")} AS ema, CASE WHEN l > 0 THEN {sql4("100 - 100 / (1 + g / l)")} END AS rsi, false AS late FROM e
 UNION ALL SELECT -event_id - 1, entity, NULL, NULL, true FROM ticks SEMI JOIN kn USING (entity) WHERE ts < TIMESTAMP '2024-01-05 00:00:00'"""),
)
def _(m):
    """Three phases, each a restart of the query, the last with rows that come too late: they are marked and do not count."""
    phases = Phases(m, "momentum")
    cut = F.lit(CUT).cast("timestamp")
    late = m.ticks.filter("ts < TIMESTAMP'2024-01-05 00:00:00'").withColumn("event_id", -F.col("event_id") - 1)
    known = m.ticks.filter((F.col("ts") < cut) & (F.col("ts") >= F.lit("2024-01-05").cast("timestamp"))).select("entity").distinct()
    early = m.ticks.filter("ts < TIMESTAMP'2024-01-12 00:00:00'")
    middle = m.ticks.filter((F.col("ts") >= F.lit("2024-01-12").cast("timestamp")) & (F.col("ts") < cut))
    rest = m.ticks.filter(F.col("ts") >= cut).unionByName(late.join(known, "entity", "left_semi"))
    for rows in (early, middle, rest):
        phases.feed(rows)
        means = state.momentum(phases.stream(), ttl_ms=30 * 86_400_000)
        engine.run_to_folder(means, phases.base, keyed_state=True)
    return engine.output(m.spark, phases.base, means).select("event_id", "entity", r4("ema").alias("ema"), r4("rsi").alias("rsi"), "late")


@query("str08_latest_per_key", with_sql("ticks", body=f"SELECT entity, arg_max(event_id, row(ts, event_id)) AS event_id, {sql4('arg_max(price, row(ts, event_id))')} AS price FROM ticks GROUP BY 1"))
def _(m):
    """Three phases; every batch rewrites only the buckets its keys fall into."""
    phases = Phases(m, "compacted")
    newest = state.Buckets(f"{phases.base}/state", ["entity"], "entity string, event_id bigint, price double, at struct<ts:timestamp,event_id:bigint>", buckets=16)
    for cond in ("ts < TIMESTAMP'2024-01-12 00:00:00'", f"ts >= TIMESTAMP'2024-01-12 00:00:00' AND ts < TIMESTAMP'{CUT}'", f"ts >= TIMESTAMP'{CUT}'"):
        phases.feed(m.ticks.filter(cond))
        rows = phases.stream().select("entity", "event_id", "price", F.struct("ts", "event_id").alias("at"))
        engine.run_batches(rows, phases.base, state.latest_step(["entity"], "at", newest))
    return newest.rows(m.spark).select("entity", "event_id", r4("price").alias("price"))


@query("str09_stream_static_join", with_sql("ticks", body="SELECT c_mktsegment AS segment, count(*) AS n FROM ticks LEFT JOIN customer ON entity = 'U' || c_custkey GROUP BY 1"))
def _(m):
    base = fresh_path(m.spark, "enriched")
    master = m.table("customer").select(F.concat(F.lit("U"), "c_custkey").alias("entity"), F.col("c_mktsegment").alias("segment"))
    rows = tick_stream(m).select("event_id", "entity").join(master, "entity", "left")
    engine.run_to_folder(rows, base)
    return engine.output(m.spark, base, rows).groupBy("segment").agg(F.count("*").alias("n"))


@query(
    "str10_interval_join",
    with_sql("ticks", body="""SELECT a.event_id AS click_id, b.event_id AS purchase_id, a.entity FROM ticks a JOIN ticks b ON a.entity = b.entity AND a.kind = 'click' AND b.kind = 'purchase' AND b.ts BETWEEN a.ts AND a.ts + INTERVAL 1 HOUR"""),
)
def _(m):
    base = fresh_path(m.spark, "interval")

    def side(kind, p):
        return tick_stream(m).filter(F.col("kind") == kind).select(F.col("event_id").alias(f"{p}_id"), F.col("entity").alias(f"{p}_entity"), F.col("ts").alias(f"{p}_ts"))

    pairs = ops.interval_join(side("click", "l"), side("purchase", "r"), "entity", 3600, "2 hours")
    pairs = pairs.select(F.col("l_id").alias("click_id"), F.col("r_id").alias("purchase_id"), F.col("l_entity").alias("entity"))
    engine.run_to_folder(pairs, base)
    return engine.output(m.spark, base, pairs)


@query(
    "str11_batch_stream_parity",
    with_sql("ticks", body=f"SELECT count(*) AS n, 0 AS only_batch, 0 AS only_stream, CAST(0.0 AS DOUBLE) AS mean_drift, CAST(0.0 AS DOUBLE) AS null_rate_drift FROM ({hourly_sql(f'date_trunc({chr(39)}hour{chr(39)}, max(ts)) + INTERVAL 1 HOUR <= {WM} - INTERVAL 30 MINUTE')})"),
)
def _(m):
    base = fresh_path(m.spark, "parity")
    candles = ops.tumbling_candles(tick_stream(m), "ts", "1 hour", "30 minutes", ["kind"])
    engine.run_to_folder(candles, base)
    at = F.struct("ts", "event_id")
    limit = m.ticks.agg(F.max("ts")).scalar() - F.expr("INTERVAL 30 MINUTES")
    batch = m.ticks.groupBy(F.window("ts", "1 hour").alias("w"), "kind").agg(
        F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", at).alias("close"), F.count("*").alias("n")
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "kind", "open", "high", "low", "close", "n")
    out = ops.reconcile(batch.filter(F.col("window_end") <= limit), engine.output(m.spark, base, candles), "close")
    return out.withColumns({c: F.abs(r4(c)) for c in ("mean_drift", "null_rate_drift")})


FRESH_SQL = "(epoch(TIMESTAMP '2024-02-01 00:00:00') - floor(epoch(max(ts)))) / 3600"


@query(
    "str12_stream_monitoring",
    with_sql("ticks", body=f"""SELECT 0 AS batch, CAST(count(*) + count_if(event_id % 10 = 0) AS BIGINT) AS events, CAST(count_if(event_id % 10 = 0) AS BIGINT) AS duplicated_ids,
 CAST(count_if(event_id % 10 = 0) AS BIGINT) AS repeats, {sql4(FRESH_SQL)} AS freshness_hours FROM ticks WHERE ts < TIMESTAMP '{CUT}'
 UNION ALL SELECT 1, CAST(count_if(new) + count_if(old) AS BIGINT), CAST(count_if(old) AS BIGINT), CAST(count_if(old) AS BIGINT), {sql4(FRESH_SQL)}
 FROM (SELECT ts, ts >= TIMESTAMP '{CUT}' AS new, ts < TIMESTAMP '{CUT}' AND event_id % 7 = 0 AS old FROM ticks) WHERE new OR old"""),
)
def _(m):
    """Ids repeated inside a batch, and ids of an earlier batch that come again in a later one."""
    phases = Phases(m, "monitor")
    step = state.seen_step(phases.base, "2024-02-01 00:00:00", ttl_days=60)
    cut = F.lit(CUT).cast("timestamp")
    first = m.ticks.filter(F.col("ts") < cut)
    for rows in (first.unionByName(first.filter("event_id % 10 = 0")), m.ticks.filter(F.col("ts") >= cut).unionByName(first.filter("event_id % 7 = 0"))):
        phases.feed(rows)
        engine.run_batches(phases.stream(), phases.base, step)
    reports = m.spark.read.parquet(f"{phases.base}/reports")
    return reports.select(F.col("batch").cast("int").alias("batch"), "events", "duplicated_ids", "repeats", r4("freshness_hours").alias("freshness_hours"))


# --- messages in envelopes, of two schema versions, some of them bad

VERSIONS = {
    "v1": envelopes.Version("price double, kind string", {"price": lambda p: p["price"], "kind": lambda p: p["kind"]}),
    "v2": envelopes.Version("quote struct<px:double>, type string", {"price": lambda p: p["quote"]["px"], "kind": lambda p: F.lower(p["type"])}),
}


def messages_of(stream):
    """Ticks as envelope messages: odd ids in the second version, six of a hundred ids spoilt in four ways."""
    k = F.col("event_id") % 100
    first = F.to_json(F.struct("price", "kind"))
    second = F.to_json(F.struct(F.struct(F.col("price").alias("px")).alias("quote"), F.upper("kind").alias("type")))
    payload = F.when(k == 9, F.lit('"spoilt"')).when(k % 2 == 0, first).otherwise(second)
    quoted = lambda name, c: F.concat(F.lit(f'"{name}":"'), c, F.lit('",'))
    text = F.concat(
        F.lit("{"), quoted("event_id", F.col("event_id").cast("string")), quoted("event_time", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")),
        quoted("ingest_time", F.lit("2024-02-01T00:00:00")), quoted("source", F.lit("nse")),
        quoted("schema_version", F.when(k == 8, "v9").when(k % 2 == 0, "v1").otherwise("v2")), F.when(k == 7, "").otherwise(quoted("entity_id", F.col("entity"))),
        F.lit('"payload":'), payload, F.lit("}"),
    )
    text = F.when(k.isin(4, 5), F.left(text, F.lit(40))).when(k == 6, F.lit(None)).otherwise(text)
    return stream.select(F.col("entity").cast("binary").alias("key"), text.cast("binary").alias("value"))


ENVELOPE_SQL = """CASE WHEN event_id % 100 IN (4, 5, 6) THEN 'unreadable' WHEN event_id % 100 = 7 THEN 'incomplete: entity_id' WHEN event_id % 100 = 8 THEN 'unknown version'
 WHEN event_id % 100 = 9 THEN 'bad payload'"""


@query("src24_versioned_envelopes", with_sql("ticks", body=f"SELECT {ENVELOPE_SQL} ELSE 'decoded' END AS place, kind_or_none AS kind, count(*) AS n, {sql2('sum(p)')} AS total FROM (SELECT *, CASE WHEN event_id % 100 BETWEEN 4 AND 9 THEN NULL ELSE kind END AS kind_or_none, CASE WHEN event_id % 100 BETWEEN 4 AND 9 THEN NULL ELSE price END AS p FROM ticks) GROUP BY 1, 2"))
def _(m):
    """Full envelopes of two versions; what cannot be decoded is kept with its reason."""
    rows = envelopes.decoded(messages_of(tick_stream(m)), VERSIONS).drop("message")
    base = fresh_path(m.spark, "envelopes")
    engine.run_to_folder(rows, base)
    out = engine.output(m.spark, base, rows)
    fine = F.col("reason").isNull()
    return out.groupBy(F.coalesce("reason", F.lit("decoded")).alias("place"), F.when(fine, F.col("kind")).alias("kind")).agg(
        F.count("*").alias("n"), r2(F.sum(F.when(fine, F.col("price")))).alias("total")
    )


@query(
    "str03_normalise_and_split",
    with_sql("ticks", body=f"""SELECT {ENVELOPE_SQL} WHEN price < 5 OR kind = 'error' THEN 'quarantined' ELSE 'good' END AS place, CASE WHEN event_id % 100 BETWEEN 4 AND 9 THEN NULL ELSE entity || ':NSE' END AS instrument_id, count(*) AS n FROM ticks GROUP BY 1, 2"""),
)
def _(m):
    """Decoding, normalising and the quality split in one step of the stream."""
    base = fresh_path(m.spark, "envelope-split")

    def normal(rows):
        return rows.withColumn("instrument_id", F.concat("entity_id", F.lit(":"), F.upper("source"))).withColumn("trade_date", F.to_date("event_time"))

    def checks(_):
        return [
            rules.Check("small_price", "critical", "price", F.col("price") < 5, F.lit("small")),
            rules.Check("error_event", "warning", "kind", F.col("kind") == "error", F.lit("error")),
        ]

    engine.run_batches(messages_of(tick_stream(m)), base, envelopes.envelope_step(VERSIONS, normal, checks, base, "ticks", CUT))
    good = m.spark.read.parquet(f"{base}/good").select(F.lit("good").alias("place"), "instrument_id")
    bad = m.spark.read.parquet(f"{base}/quarantine").select(F.lit("quarantined").alias("place"), "instrument_id")
    rejected = m.spark.read.parquet(f"{base}/rejected").select(F.col("reason").alias("place"), F.lit(None).cast("string").alias("instrument_id"))
    return good.unionByName(bad).unionByName(rejected).groupBy("place", "instrument_id").agg(F.count("*").alias("n"))
