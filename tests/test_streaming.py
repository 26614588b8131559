import datetime as dt
import pathlib
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ticklake.session import fresh_path
from ticklake.streaming import engine, envelopes, state
from ticklake.streaming import operators as ops

T0 = dt.datetime(2024, 1, 1)


def ticks(spark, *rows):
    made = [(i, T0 + dt.timedelta(minutes=m), e, "k", float(p), None) for i, m, e, p in rows or [(0, 0, "a", 0)]]
    return spark.createDataFrame(made, engine.TICK_SCHEMA)


def topic(spark, rows, label="topic"):
    base = fresh_path(spark, label)
    rows.write.parquet(f"{base}/topic")
    return base, engine.read_stream(spark, f"{base}/topic", engine.TICK_SCHEMA)


def test_late_rows_are_dropped_and_counted(spark):
    base, stream = topic(spark, ticks(spark, (1, 5, "a", 1), (2, 200, "a", 2)))
    candles = ops.tumbling_candles(stream, "ts", "1 hour", "10 minutes", ["entity"])
    engine.run_to_folder(candles, base)
    ticks(spark, (3, 10, "a", 99), (4, 400, "a", 3)).write.mode("append").parquet(f"{base}/topic")
    query = engine.run_to_folder(candles, base)
    assert engine.late_rows(query) == 1
    got = engine.output(spark, base, candles).orderBy("window_start").collect()
    assert [(r["open"], r["n"]) for r in got] == [(1.0, 1), (2.0, 1)]


def test_restart_does_not_repeat_output(spark):
    base, stream = topic(spark, ticks(spark, (1, 1, "a", 1), (1, 1, "a", 1), (2, 2, "a", 2)))
    unique = ops.dedupe(stream, "event_id", "ts", "1 hour")
    engine.run_to_folder(unique, base)
    engine.run_to_folder(unique, base)
    assert engine.output(spark, base, unique).count() == 2


def test_momentum_over_batches_equals_one_pass(spark):
    base = fresh_path(spark, "momentum")
    step = ops.momentum_step(f"{base}/rows", f"{base}/state", f"{base}/late", span=5, n=3)
    prices = [100 + (i * 37 % 11) for i in range(40)]
    rows = [(i, i, "a" if i % 4 else "b", p) for i, p in enumerate(prices)]
    for number, part in enumerate((rows[:7], rows[7:8], rows[8:])):
        step(ticks(spark, *part), number)
        step(ticks(spark, *part), number)  # a repeated batch changes nothing
    got = spark.read.parquet(f"{base}/rows").toPandas().sort_values("event_id")
    assert len(got) == 40
    for entity, g in got.groupby("entity"):
        mine = pd.Series([float(p) for _, _, e, p in rows if e == entity])
        assert list(g["ema"]) == pytest.approx(list(mine.ewm(span=5, adjust=False).mean()))
        gain = mine.diff().clip(lower=0).fillna(0).ewm(span=3, adjust=False).mean()
        assert list(g["gain"]) == pytest.approx(list(gain))


def test_momentum_rejects_old_rows(spark):
    base = fresh_path(spark, "momentum")
    step = ops.momentum_step(f"{base}/rows", f"{base}/state", f"{base}/late")
    step(ticks(spark, (2, 10, "a", 5)), 0)
    # equal times are told apart by the id
    step(ticks(spark, (1, 10, "a", 1), (5, 10, "a", 2), (6, 9, "a", 500), (3, 11, "a", 6), (4, 1, "new", 7)), 1)
    assert sorted(r["event_id"] for r in spark.read.parquet(f"{base}/rows").collect()) == [2, 3, 4, 5]
    assert sorted(r["event_id"] for r in spark.read.parquet(f"{base}/late").collect()) == [1, 6]


SCHEMA = "entity string, ts timestamp, price double"


def parts(base):
    """Data files by (version, bucket)."""
    found = {}
    for f in pathlib.Path(base).glob("data/version=*/bucket=*/part-*"):
        version, bucket = (int(x.split("=")[1]) for x in f.parts[-3:-1])
        found.setdefault((version, bucket), []).append(f.name)
    return found


def test_latest_state_survives_a_repeated_batch(spark):
    newest = state.Buckets(fresh_path(spark, "latest"), ["entity"], SCHEMA)
    step = state.latest_step(["entity"], "ts", newest)
    step(ticks(spark, (1, 5, "a", 1), (2, 6, "b", 2)), 0)
    for _ in range(2):
        step(ticks(spark, (3, 4, "a", 9), (4, 7, "b", 3), (5, 1, None, 4)), 1)
    step(ticks(spark).limit(0), 2)
    assert sorted((str(r["entity"]), r["price"]) for r in newest.rows(spark).collect()) == [("None", 4.0), ("a", 1.0), ("b", 3.0)]


def test_a_batch_rewrites_only_its_buckets(spark):
    newest = state.Buckets(fresh_path(spark, "buckets"), ["entity"], SCHEMA, buckets=8, keep=2)
    step = state.latest_step(["entity"], "ts", newest)
    everyone = [f"e{k}" for k in range(200)]
    step(ticks(spark, *[(k, k, e, k) for k, e in enumerate(everyone)]), 0)
    assert {v for v, _ in parts(newest.path)} == {0} and len(parts(newest.path)) == 8
    for n in range(1, 6):
        step(ticks(spark, (1000 + n, 1000 + n, "e7", 1000 + n)), n)
        mine = {b for v, b in parts(newest.path) if v == n}
        assert len(mine) == 1
    # of the one bucket the last two versions are left, of the others the first
    left = parts(newest.path)
    assert sorted(v for v, b in left if b in mine) == [4, 5] and sorted(v for v, b in left if b not in mine) == [0] * 7
    got = {r["entity"]: r["price"] for r in newest.rows(spark).collect()}
    assert got == {e: 1005.0 if e == "e7" else float(k) for k, e in enumerate(everyone)}


def test_a_batch_without_commit_is_not_seen(spark):
    newest = state.Buckets(fresh_path(spark, "broken"), ["entity"], SCHEMA, buckets=2)
    step = state.latest_step(["entity"], "ts", newest)
    step(ticks(spark, (1, 5, "a", 1)), 0)
    spark.createDataFrame([("a", T0, 99.0, 0)], f"{SCHEMA}, bucket int").write.partitionBy("bucket").parquet(f"{newest.path}/data/version=1")
    assert [r["price"] for r in newest.rows(spark).collect()] == [1.0]
    step(ticks(spark, (2, 6, "a", 2)), 1)
    assert [r["price"] for r in newest.rows(spark).collect()] == [2.0]
    with pytest.raises(ValueError, match="keep"):
        state.Buckets("x", ["entity"], SCHEMA, keep=1)


def test_momentum_in_the_state_store_goes_on_after_restarts(spark):
    base = fresh_path(spark, "momentum")
    prices = [None if i % 13 == 5 else 100.0 + (i * 37 % 11) for i in range(60)]
    rows = [(i, T0 + dt.timedelta(minutes=i), "a" if i % 4 else "b", "k", p, None) for i, p in enumerate(prices)]
    late = [(900, T0, "a", "k", 1.0, None), (901, T0, "b", "k", 1.0, None), (902, T0, "new", "k", 5.0, None)]
    for part in (rows[:20], rows[20:21], rows[21:] + late):
        spark.createDataFrame(part, engine.TICK_SCHEMA).write.mode("append").parquet(f"{base}/topic")
        means = state.momentum(engine.read_stream(spark, f"{base}/topic", engine.TICK_SCHEMA), span=5, n=3)
        engine.run_to_folder(means, base, keyed_state=True)
    got = engine.output(spark, base, means).toPandas().sort_values("event_id")
    assert sorted(got[got["late"]]["event_id"]) == [900, 901] and got[got["late"]]["ema"].isna().all()
    fine = got[~got["late"] & (got["event_id"] < 900)]
    assert len(fine) == 60 and list(got[got["event_id"] == 902]["ema"]) == [5.0]
    for entity, g in fine.groupby("entity"):
        mine = pd.Series([p for _, _, e, _, p, _ in rows if e == entity], dtype=float)
        assert list(g["ema"]) == pytest.approx(list(mine.ewm(span=5, adjust=False, ignore_na=True).mean()))
        solid = mine.dropna()
        gain = solid.diff().clip(lower=0).fillna(0).ewm(span=3, adjust=False).mean().reindex(mine.index).ffill()
        assert list(g["gain"]) == pytest.approx(list(gain))
        loss = (-solid.diff()).clip(lower=0).fillna(0).ewm(span=3, adjust=False).mean().reindex(mine.index).ffill()
        rsi = (100 - 100 / (1 + gain / loss)).where(loss > 0)
        assert list(g["rsi"].fillna(-1)) == pytest.approx(list(rsi.fillna(-1)))


def test_idle_entities_expire(spark):
    base = fresh_path(spark, "expire")
    for k in range(2):
        ticks(spark, (k, k, "a", 10 + 10 * k)).write.mode("append").parquet(f"{base}/topic")
        means = state.momentum(engine.read_stream(spark, f"{base}/topic", engine.TICK_SCHEMA), span=3, ttl_ms=1)
        engine.run_to_folder(means, base, keyed_state=True)
        time.sleep(0.1)
    assert sorted(r["ema"] for r in engine.output(spark, base, means).collect()) == [10.0, 20.0]


def reports(spark, base):
    return {r["batch"]: (r["events"], r["duplicated_ids"], r["repeats"]) for r in spark.read.parquet(f"{base}/reports").collect()}


def test_ids_of_earlier_batches_are_known(spark):
    base = fresh_path(spark, "seen")
    step = state.seen_step(base, "2024-02-01 00:00:00", ttl_days=3)
    day = 24 * 60
    step(ticks(spark, (1, 0, "a", 1), (1, 0, "a", 1), (2, 5, "a", 1), (None, 5, "a", 1)), 0)
    for _ in range(2):  # a repeated batch reports the same
        step(ticks(spark, (1, 0, "a", 1), (2, 5, "b", 1), (2, 5, "b", 1), (3, day, "a", 1), (None, 5, "a", 1)), 1)
    assert reports(spark, base) == {0: (4, 1, 1), 1: (5, 3, 4)}
    step(ticks(spark, (9, 5 * day, "a", 1)), 2)  # the first day is forgotten now
    step(ticks(spark, (1, 0, "a", 1), (9, 5 * day, "a", 1)), 3)
    step(ticks(spark).limit(0), 4)
    assert reports(spark, base)[3] == (2, 1, 1) and reports(spark, base)[4] == (0, 0, 0)
    no_time = spark.createDataFrame([(5, None, "a", "k", 1.0, None)], engine.TICK_SCHEMA)
    step(no_time, 5)
    assert reports(spark, base)[5] == (1, 0, 0)


def test_lateness_differs_by_topic(spark):
    base = fresh_path(spark, "lateness")
    step = state.lateness_step("entity", "ts", {"slow": 3600}, base, default_seconds=600)
    step(ticks(spark, (1, 100, "slow", 1), (2, 100, "fast", 1), (3, 0, "fast", 1)), 0)
    batch = ticks(spark, (4, 45, "slow", 1), (5, 39, "slow", 1), (6, 45, "fast", 1), (7, 90, "fast", 1), (8, 1, "new", 1), (9, 1, None, 1))
    for _ in range(2):
        step(batch, 1)
    ids = lambda place: sorted(r["event_id"] for r in spark.read.parquet(f"{base}/{place}").collect())
    assert ids("late") == [5, 6] and ids("kept") == [1, 2, 3, 4, 7, 8, 9]


def test_watermarks_by_topic_wait_for_the_slowest(spark):
    base, _ = topic(spark, ticks(spark, (1, 5, "a", 1), (2, 5, "b", 2), (3, 300, "a", 1)))
    for policy, windows in (("min", 0), ("max", 2)):
        stream = state.by_topic(engine.read_stream(spark, f"{base}/topic", engine.TICK_SCHEMA), "entity", "ts", {"a": "10 minutes", "b": "10 minutes"})
        candles = ops.tumbling_candles(stream, "ts", "1 hour", None, ["entity"])
        engine.run_to_folder(candles, f"{base}/{policy}", policy=policy)
        assert engine.output(spark, f"{base}/{policy}", candles).count() == windows
    assert spark.conf.get("spark.sql.streaming.multipleWatermarkPolicy", "min") == "min"


VERSIONS = {
    "v1": envelopes.Version("px double", {"px": lambda p: p["px"]}),
    "v2": envelopes.Version("q struct<px:double>", {"px": lambda p: p["q"]["px"]}),
}


def message(version="v1", payload='{"px": 1.5}', **fields):
    known = {"event_id": "e", "event_time": "2024-01-01T00:00:00", "ingest_time": "2024-01-01T00:00:01", "source": "nse", "schema_version": version, "entity_id": "A"} | fields
    return "{" + ", ".join(f'"{k}": "{v}"' for k, v in known.items() if v is not None) + f', "payload": {payload}' + "}"


def test_envelopes_of_two_versions_and_bad_messages(spark):
    texts = {
        message(): (1.5, None), message("v2", '{"q": {"px": 2.5}}'): (2.5, None), message("v3"): (None, "unknown version"), message(payload='"x"'): (None, "bad payload"),
        message(payload='{"px": "much"}'): (None, "bad payload"), message(entity_id=None): (None, "incomplete: entity_id"), message(event_time="soon"): (None, "incomplete: event_time"),
        message(payload="null"): (None, "incomplete: payload"), "{": (None, "unreadable"), "[1]": (None, "unreadable"), "": (None, "unreadable"), message(payload="{}"): (None, None),
    }
    rows = spark.createDataFrame([(t,) for t in [*texts, None]], "value string")
    got = {r["message"]: (r["px"] if r["reason"] is None else None, r["reason"]) for r in envelopes.decoded(rows, VERSIONS).collect()}
    assert got == {**texts, None: (None, "unreadable")}
    with pytest.raises(ValueError, match="same columns"):
        envelopes.decoded(rows, {**VERSIONS, "v4": envelopes.Version("z int", {"z": lambda p: p["z"]})})


def test_sessions_split_on_gaps(spark):
    base, stream = topic(spark, ticks(spark, (1, 0, "a", 1), (2, 20, "a", 1), (3, 90, "a", 1), (4, 1000, "z", 1)))
    found = ops.sessions(stream, "ts", "30 minutes", "1 minute", ["entity"])
    engine.run_to_folder(found, base)
    assert sorted(r["n"] for r in engine.output(spark, base, found).collect()) == [1, 2]


def test_reconcile_sees_differences(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, v double")
    b = spark.createDataFrame([(1, 1.0), (3, None)], "k int, v double")
    r = ops.reconcile(a, b, "v").first()
    assert (r["only_batch"], r["only_stream"], r["mean_drift"], r["null_rate_drift"]) == (1, 1, -0.5, 0.5)


def test_messages_carry_json_values(spark):
    df = spark.createDataFrame([("a", '{"event_id": 7, "price": 1.5}')], "key string, value string")
    row = engine.from_topic(df.select(F.col("key").cast("binary"), F.col("value").cast("binary")), "event_id bigint, price double").first()
    assert (row["entity_id"], row["event_id"], row["price"]) == ("a", 7, 1.5)


def test_interval_join_pairs_once_across_slots(spark):
    base = fresh_path(spark, "interval")
    rows = ticks(spark, *[(i, m, "a", 1) for i, m in enumerate((0, 29, 30, 31, 59, 60, 61, 200))])
    rows.write.parquet(f"{base}/topic")

    def side(p):
        s = engine.read_stream(spark, f"{base}/topic", engine.TICK_SCHEMA)
        return s.select(F.col("event_id").alias(f"{p}_id"), F.col("entity").alias(f"{p}_entity"), F.col("ts").alias(f"{p}_ts"))

    pairs = ops.interval_join(side("l"), side("r"), "entity", 1800, "1 hour").select("l_id", "r_id")
    engine.run_to_folder(pairs, base)
    minutes = (0, 29, 30, 31, 59, 60, 61, 200)
    want = sorted((i, j) for i, a in enumerate(minutes) for j, b in enumerate(minutes) if 0 <= b - a <= 30)
    assert sorted((r["l_id"], r["r_id"]) for r in engine.output(spark, base, pairs).collect()) == want


def test_an_entity_of_few_rows_costs_little():
    """Momentum of one entity takes plain lists: 300 entities in less than a second (17 ms each as table operations)."""
    import time

    import pandas as pd

    from ticklake.streaming.state import Momentum

    class Held:
        value = None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    step, n = Momentum(12, 14, None), 300
    prices = [10.0, None, 12.0, 9.0, 11.0]
    batch = pd.DataFrame({"event_id": range(5), "us": [5, 1, 2, 3, 4], "price": prices})
    began = time.process_time()
    for i in range(n):
        step.state = Held()
        out = pd.concat(step.handleInputRows((f"U{i}",), iter([batch]), None))
    assert time.process_time() - began < 1.5
    price = pd.Series(prices[1:] + prices[:1])
    assert list(out["event_id"]) == [1, 2, 3, 4, 0]
    assert abs(out["ema"] - price.ewm(span=12, adjust=False, ignore_na=True).mean()).max() < 1e-9
    late = pd.concat(step.handleInputRows(("U",), iter([batch[:1].assign(us=0)]), None))
    assert late["late"].all() and late["ema"].isna().all()
