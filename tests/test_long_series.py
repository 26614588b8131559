"""Operators for series of any length, with one key that holds most of the rows."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ticklake.operators import asof, series
from ticklake.operators.asof import asof_join, by_month, time_bucket

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def ticks(spark):
    rows = []
    for i in range(9000):
        key = "hot" if i % 3 else (None if i % 30 == 9 else f"k{i % 30}")
        rows.append((i, key, START + dt.timedelta(seconds=(i * 613) % 500_000), float((i * 7919) % 997)))
    return spark.createDataFrame(rows, "event_id bigint, kind string, ts timestamp, price double").cache()



def test_positions_match_one_window(ticks):
    got = series.positions(ticks, ["kind"], ["ts", "event_id"], F.date_trunc("hour", "ts"))
    want = F.row_number().over(Window.partitionBy("kind").orderBy("ts", "event_id")) - 1
    assert got.withColumn("w", want).filter("w <> pos").count() == 0


@pytest.mark.parametrize("rows", [1, 2, 20, 300])
def test_rolling_matches_one_window(ticks, rows, monkeypatch):
    monkeypatch.setattr(series, "LONG_BLOCK_ROWS", 64)
    monkeypatch.setattr(series.overlapping_blocks, "__defaults__", (64,))
    got = series.rolling_long(ticks, ["kind"], ["ts", "event_id"], F.date_trunc("day", "ts"), rows, {"s": F.sum("price"), "n": F.count("price")})
    w = Window.partitionBy("kind").orderBy("ts", "event_id").rowsBetween(-(rows - 1), 0)
    want = ticks.withColumns({"s": F.sum("price").over(w), "n": F.count("price").over(w)})
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_lag_matches_one_window(ticks):
    got = series.lag_long(ticks, ["kind"], ["ts", "event_id"], F.date_trunc("hour", "ts"), "price", "prev")
    want = ticks.withColumn("prev", F.lag("price").over(Window.partitionBy("kind").orderBy("ts", "event_id")))
    assert got.exceptAll(want.select(*got.columns)).count() == 0


@pytest.mark.parametrize("span", [2, 12, 200])
def test_ema_matches_recursion(ticks, span):
    got = series.ema_long(ticks, {"e": ("price", span)}, ["kind"], ["ts", "event_id"], F.date_trunc("hour", "ts"))
    pdf = got.toPandas().fillna({"kind": "none"}).sort_values(["kind", "ts", "event_id"])
    want = pdf.groupby("kind")["price"].transform(lambda s: s.ewm(span=span, adjust=False).mean())
    assert list(pdf["e"]) == pytest.approx(list(want), rel=1e-9)


def test_ema_continues_from_a_seed(spark):
    rows = [(i, "a", START + dt.timedelta(seconds=i), 10.0 + i % 7, 50.0) for i in range(600)]
    df = spark.createDataFrame(rows, "event_id bigint, kind string, ts timestamp, price double, seed double")
    got = series.ema_long(df, {"e": ("price", 9)}, ["kind"], ["ts", "event_id"], F.date_trunc("hour", "ts"), seeds={"e": "seed"})
    e, want = 50.0, []
    for r in rows:
        e = 0.8 * e + 0.2 * r[3]
        want.append(e)
    assert [r["e"] for r in got.orderBy("event_id").collect()] == pytest.approx(want, rel=1e-12)


def test_time_bucket_unit_does_not_change_results(ticks):
    runs = [series.lag_long(ticks, ["kind"], ["ts", "event_id"], time_bucket(u)(F.col("ts")), "price", "prev") for u in ("month", "hour", "minute")]
    assert all(runs[0].exceptAll(r).count() == 0 and r.exceptAll(runs[0]).count() == 0 for r in runs[1:])
    with pytest.raises(ValueError):
        time_bucket("week")


def frames(spark):
    left = [(i, "hot" if i % 3 else "cold", dt.date(2024, 1, 1) + dt.timedelta(days=(i * 17) % 400)) for i in range(600)]
    right = [("hot", dt.date(2024, 1, 1) + dt.timedelta(days=d), float(d)) for d in range(5, 380, 23)]
    right += [("cold", dt.date(2024, 6, 1), 1.5), ("other", dt.date(2024, 1, 1), 9.0), (None, dt.date(2024, 1, 1), 7.0)]
    left += [(1000, None, dt.date(2024, 3, 1)), (1001, "absent", dt.date(2024, 3, 1))]
    return (
        spark.createDataFrame(left, "id bigint, k string, d date"), spark.createDataFrame(right, "k string, at date, v double"),
        pd.DataFrame(left, columns=["id", "k", "d"]), pd.DataFrame(right, columns=["k", "at", "v"]),
    )


def brute(left, right, direction, exact, tolerance):
    out = {}
    for _, row in left.iterrows():
        best = None
        for _, r in right.iterrows():
            if row["k"] is None or r["k"] != row["k"]:
                continue
            gap = (row["d"] - r["at"]).days
            if (gap == 0 and not exact) or (direction == "backward" and gap < 0) or (direction == "forward" and gap > 0):
                continue
            if tolerance is not None and abs(gap) > tolerance:
                continue
            # nearest prefers the earlier row on a tie
            rank = (abs(gap), 0 if gap >= 0 else 1)
            if best is None or rank < best[0]:
                best = (rank, r["v"])
        out[row["id"]] = best[1] if best else None
    return out


@pytest.mark.parametrize("bucket", [None, by_month])
@pytest.mark.parametrize("direction,exact,tolerance", [("backward", True, None), ("backward", False, 10), ("forward", True, 7), ("forward", False, None), ("nearest", True, None)])
def test_asof_matches_brute_force(spark, bucket, direction, exact, tolerance):
    left, right, pl, pr = frames(spark)
    got = asof_join(left, right, ["k"], "d", "at", ["v"], direction, exact, tolerance, bucket)
    assert got.columns == ["id", "k", "d", "v"]
    assert {r["id"]: r["v"] for r in got.collect()} == brute(pl, pr, direction, exact, tolerance)


def test_asof_collapse_keeps_every_left_row(spark):
    left, right, pl, pr = frames(spark)
    doubled = left.unionByName(left.withColumn("id", F.col("id") + 5000))
    got = {r["id"]: r["v"] for r in asof_join(doubled, right, ["k"], "d", "at", ["v"], collapse=True).collect()}
    want = brute(pl, pr, "backward", True, None)
    assert got == {**want, **{k + 5000: v for k, v in want.items()}}


def test_asof_rejects_unknown_direction(spark):
    left, right, _, _ = frames(spark)
    with pytest.raises(ValueError):
        asof_join(left, right, ["k"], "d", "at", ["v"], "sideways")


def pairs(ticks):
    """Ticks with prices as the right side, at most one a key and time, and the others as the left."""
    right = ticks.filter("event_id % 3 = 1").groupBy("kind", "ts").agg(F.max("price").alias("quote")).withColumn("at", F.col("ts"))
    left = ticks.filter("event_id % 3 <> 1").withColumn("ts", F.when(F.col("event_id") % 50 != 0, F.col("ts")))
    return left, right


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("limit", [40, 700, 10**6])
def test_spread_asof_equals_one_sort(ticks, direction, limit):
    left, right = pairs(ticks)
    args = (["kind"], "ts", "at", ["quote"], direction)
    got, want = asof_join(left, right, *args, spread=limit), asof_join(left, right, *args)
    assert got.count() == left.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0
    bucketed = asof_join(left, right, *args, bucket=time_bucket("hour"))
    assert bucketed.exceptAll(want.select(*bucketed.columns)).count() == 0


def test_nearest_equals_a_plain_search(ticks):
    left, right = pairs(ticks)
    quotes = {}
    for r in right.collect():
        quotes.setdefault(r["kind"], []).append((r["at"], r["quote"]))
    for r in asof_join(left, right, ["kind"], "ts", "at", ["quote"], "nearest", tolerance_days=0.001).collect():
        best = None
        if r["ts"] is not None and r["kind"] is not None:
            # of two at the same distance the earlier one
            best = min(((abs((r["ts"] - at).total_seconds()), at, q) for at, q in quotes.get(r["kind"], [])), default=None)
        assert r["quote"] == (best[2] if best and best[0] <= 86.4 else None)


def test_spread_cuts_a_hot_key_into_even_tasks(ticks, monkeypatch):
    """One key with two thirds of the rows, crowded in time: no task sorts much more than the limit."""
    crowded = ticks.withColumn("ts", F.when(F.col("event_id") % 2 == 0, F.timestamp_seconds(F.lit(1_704_067_200) + F.col("event_id") / 1000)).otherwise(F.col("ts")))
    left, right = pairs(crowded)
    seen = {}
    real = asof._spread
    monkeypatch.setattr(asof, "_spread", lambda *a: seen.setdefault("rows", real(*a)))
    asof.asof_join(left, right, ["kind"], "ts", "at", ["quote"], spread=500).count()
    sizes = {tuple(r)[:2]: r["count"] for r in seen["rows"].groupBy("_k_kind", "_bucket").count().collect()}
    hot = [n for (k, b), n in sizes.items() if k == "hot" and b >= 0]
    assert len(hot) >= 8 and max(hot) <= 1500
    assert max(n for (k, b), n in sizes.items() if b < 0) <= 10


def test_spread_reads_the_left_side_once(ticks):
    calls = ticks.sparkSession.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            calls.add(len(b))
            yield b

    left, right = pairs(ticks)
    left = left.select("event_id", "kind", "ts").mapInPandas(counted, "event_id bigint, kind string, ts timestamp")
    assert asof_join(left, right, ["kind"], "ts", "at", ["quote"], spread=500).count() == calls.value
