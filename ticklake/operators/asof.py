"""As-of join: one tagged union, one shuffle, no fan-out.

Left and right rows are stacked, sorted by time inside each key, and the last right row seen is
carried onto each left row; ``nearest`` looks both ways in the same sort.  Without more, a key's rows share
one sort.  Two ways spread a key that holds a large share of all rows over many tasks: ``bucket``, a function of
the time column, or ``spread``, which cuts the time of busy keys at quantiles of their own rows.  The shuffle key
then is (key, bucket), and the last right row of the earlier buckets is carried in as one extra row per
bucket, found on map-side aggregated bucket summaries.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake.session import fresh_path

Bucket = Callable[[Column], Column]

#: rows of one key that one task may sort
SPREAD_ROWS = 1_000_000
#: sampled rows for each cut
DRAWN = 20


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: list[str],
    left_on: str,
    right_on: str,
    take: list[str],
    direction: str = "backward",
    allow_exact: bool = True,
    tolerance_days: float | None = None,
    bucket: Bucket | None = None,
    collapse: bool = False,
    spread: int | None = None,
) -> DataFrame:
    """Left rows plus ``take`` columns of the matching right row (nulls when none matches).

    ``direction`` is backward (latest right row at or before), forward (earliest at or after) or
    nearest (ties go backward; equal times always count).  Right rows must be unique per (by, right_on).

    ``spread`` says how many rows of one key a task may sort (``SPREAD_ROWS`` is a good number); it needs no time
    unit.  Both sides are then evaluated once and written, busy keys are found by counting, and their time is cut at
    quantiles of a sample.

    ``collapse`` matches each distinct (by, time) of the left side once and joins the answer back:
    right for many left rows per day, where the calendar then bounds every sort.
    """
    if direction not in ("backward", "forward", "nearest"):
        raise ValueError(f"unknown direction {direction}")
    if collapse:
        points = left.select(*by, left_on).filter(F.col(left_on).isNotNull()).distinct()
        found = asof_join(
            points, right, by, left_on, right_on, take, direction, allow_exact, tolerance_days, bucket, spread=spread
        )
        return left.join(found, [*by, left_on], "left").select(*left.columns, *take)

    both = direction == "nearest"
    forward = direction == "forward"
    r_struct = F.struct(F.col(right_on).alias("_rt"), *[F.col(c).alias(f"_r_{c}") for c in take])
    # at equal times a right row must come before the left row exactly when equality counts
    side_r, side_l = (0, 1) if allow_exact or both else (1, 0)
    keys = [F.col(c).alias(f"_k_{c}") for c in by]
    # a null key or time matches nothing
    r = right.dropna(subset=[*by, right_on]).select(
        *keys, F.col(right_on).alias("_t"), F.lit(side_r).alias("_side"), r_struct.alias("_r")
    )
    rest = [c for c in left.columns if c not in by and c != left_on]
    l_struct = F.struct(*[F.col(c) for c in rest]) if rest else F.struct(F.lit(1).alias("_any"))
    lft = left.select(*keys, F.col(left_on).alias("_t"), F.lit(side_l).alias("_side"), l_struct.alias("_l"))
    rows = lft.unionByName(r, allowMissingColumns=True)
    part = [f"_k_{c}" for c in by]

    if spread is not None:
        rows = _spread(rows, part, spread)
    elif bucket is not None:
        rows = rows.withColumn("_bucket", bucket(F.col("_t")))
    if spread is not None or bucket is not None:
        carried = [_carry(rows, part, ahead) for ahead in ((False, True) if both else (forward,))]
        for extra in carried:
            rows = rows.unionByName(extra, allowMissingColumns=True)
        part = [*part, "_bucket"]

    when = F.col("_t").desc() if forward else F.col("_t").asc()
    w = Window.partitionBy(*part).orderBy(when, "_side")
    behind = F.last("_r", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    matched = rows.withColumn("_m", behind)
    if both:
        # a frame up to the last row would be read again for every row; LEAD steps through the key once
        by_key = f"PARTITION BY {', '.join(f'`{c}`' for c in part)} " if part else ""
        matched = matched.withColumn("_n", F.expr(f"lead(_r) IGNORE NULLS OVER ({by_key}ORDER BY _t, _side)"))
        nearer = _apart(F.col("_n._rt"), F.col("_t")) < _apart(F.col("_t"), F.col("_m._rt"))
        # rows without time match nothing, though they sort before all others
        timed = F.col("_t").isNotNull()
        matched = matched.withColumn("_m", F.when(timed, F.when(F.col("_m").isNull() | nearer, F.coalesce("_n", "_m")).otherwise(F.col("_m"))))
    matched = matched.filter(F.col("_l").isNotNull())
    if tolerance_days is not None:
        near_enough = _apart(F.col("_t"), F.col("_m._rt")) <= tolerance_days * 86_400
        matched = matched.withColumn("_m", F.when(near_enough, F.col("_m")))
    # keys keep their own column, so that a following window or join on them needs no new shuffle
    own = {left_on: F.col("_t"), **{c: F.col(f"_k_{c}") for c in by}}
    kept = [own[c].alias(c) if c in own else F.col(f"_l.{c}").alias(c) for c in left.columns]
    return matched.select(*kept, *[F.col(f"_m._r_{c}").alias(c) for c in take])


def _carry(rows: DataFrame, part: list[str], ahead: bool) -> DataFrame:
    """For each (key, bucket) the nearest right row of the buckets before it, or after it where ``ahead``."""
    pick = F.min_by if ahead else F.max_by
    summary = rows.groupBy(*part, "_bucket").agg(pick("_r", F.when(F.col("_r").isNotNull(), F.col("_t"))).alias("_r"))
    near = F.col("_bucket").desc() if ahead else F.col("_bucket").asc()
    earlier = Window.partitionBy(*part).orderBy(near).rowsBetween(Window.unboundedPreceding, -1)
    return (
        summary.withColumn("_r", F.last("_r", ignorenulls=True).over(earlier))
        .filter(F.col("_r").isNotNull())
        .withColumn("_t", F.col("_r._rt"))
        .withColumn("_side", F.lit(-1))
    )


def _written(df: DataFrame, label: str) -> DataFrame:
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _spread(rows: DataFrame, part: list[str], limit: int) -> DataFrame:
    """``rows`` with ``_bucket``: 0 for keys of at most ``limit`` rows, else how many cuts of its key lie at or before
    the row's time.  Cuts are one for every ``limit`` rows of a busy key, whatever the number of its distinct times;
    rows without key or time match nothing and are dealt out by number."""
    rows = _written(rows, "asof-rows")
    lone = F.col("_t").isNull()
    for k in part:
        lone = lone | F.col(k).isNull()
    busy = rows.where(~lone).groupBy(*part).agg(F.count("*").alias("_n")).where(F.col("_n") > limit)
    busy = _written(busy, "asof-busy")  # one row for every ``limit`` rows at most
    if busy.isEmpty():
        cuts = None
    else:
        drawn = rows.where(~lone).select(*part, "_t").join(busy.select(*part), part).where(F.rand(11) < min(1.0, DRAWN / limit))
        sampled = drawn.groupBy(*part).agg(F.sort_array(F.collect_list("_t")).alias("_s"))
        every = F.transform(F.sequence(F.lit(1), F.greatest(F.size("_s") / DRAWN, F.lit(1)).cast("int")), lambda k: F.get(F.col("_s"), F.least(k * DRAWN, F.size("_s")) - 1))
        cuts = _written(sampled.select(*part, F.array_distinct(every).alias("_cuts")), "asof-cuts")
    dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1024)).cast("int")
    if cuts is None:
        return rows.withColumn("_bucket", F.when(lone, -1 - dealt).otherwise(F.lit(0)))
    joined = rows.join(cuts, part, "left")
    return joined.withColumn("_bucket", F.when(lone, -1 - dealt).when(F.col("_cuts").isNull(), F.lit(0)).otherwise(_at_or_before(F.col("_cuts"), F.col("_t")))).drop("_cuts")


def _at_or_before(cuts: Column, t: Column) -> Column:
    """How many of the sorted ``cuts`` are not after ``t``, by halving."""
    start = F.struct(F.lit(0).alias("lo"), F.size(cuts).alias("hi"))
    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(cuts) + F.lit(1.0))).cast("int") + 1)

    def halve(s: Column, _: Column) -> Column:
        mid = F.shiftright(s["lo"] + s["hi"], 1)
        above = F.coalesce(F.get(cuts, mid) > t, F.lit(True))
        return F.struct(F.when(above, s["lo"]).otherwise(mid + 1).alias("lo"), F.when(above, mid).otherwise(s["hi"]).alias("hi"))

    return F.aggregate(steps, start, halve, lambda s: s["lo"])


def _apart(a: Column, b: Column) -> Column:
    """Seconds between two dates or timestamps."""
    return F.abs(a.cast("timestamp").cast("double") - b.cast("timestamp").cast("double"))


def by_month(c: Column) -> Column:
    return F.trunc(c, "MM")


TIME_UNITS = ("month", "day", "hour", "minute", "second")


def time_bucket(unit: str) -> Bucket:
    """Buckets of one time unit.

    The unit is the caller's: the coarsest one in which the busiest key stays within what a task can sort, a
    million rows or so.  Results do not depend on it.
    """
    if unit not in TIME_UNITS:
        raise ValueError(f"unit must be one of {TIME_UNITS}")
    return lambda c: F.date_trunc(unit, c)
