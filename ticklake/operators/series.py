"""Ordered series: windows over daily bars, and the same windows over long series.

Daily bars hold one row per symbol and day, so a symbol's window is bounded by the calendar
(twenty years are about 5,000 rows) whatever the data volume: plain windows partitioned by
symbol are right, and equal window specs share one shuffle and one sort.

A tick series has no such bound, and one key may hold a third of all rows.  ``positions``
numbers the rows of each key without bringing a key together: rows are counted per (key, time
bucket), the counts are summed over the earlier buckets, and only rows of one bucket are sorted
together.  ``overlapping_blocks`` then cuts each key into blocks of equal length plus the few
rows a frame reaches back to, so every task sorts a bounded block.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake.operators.asof import Bucket

BLOCK_ROWS = 256
LONG_BLOCK_ROWS = 4096


def daily(by: str = "symbol", order: str = "trade_date"):
    """The one window spec all daily-bar operators share."""
    return Window.partitionBy(by).orderBy(order)


def positions(df: DataFrame, by: list[str], order: list[str], bucket: Column, name: str = "pos", counted: Column | None = None) -> DataFrame:
    """Number rows 0,1,2… per key in ``order`` (a total order whose first column sets ``bucket``).

    With ``counted`` only rows where it holds are numbered; the others get the number of the last one before them,
    -1 if there is none.
    """
    one = F.lit(1) if counted is None else counted.cast("int")
    # one struct key keeps rows whose key is null: structs compare null fields as equal
    rows = df.withColumn("_key", F.struct(*by, bucket.alias("_bucket")))
    same = [F.col("_key")[c] for c in by]
    earlier = Window.partitionBy(*same).orderBy(F.col("_key._bucket")).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("_key")
        .agg(F.sum(one).alias("_n"))
        .select("_key", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy("_key").orderBy(*order)
    return (
        rows.join(starts, "_key")
        .withColumn(name, F.col("_start") + (F.row_number().over(inside) if counted is None else F.sum(one).over(inside)) - 1)
        .drop("_key", "_start")
    )


def overlapping_blocks(df: DataFrame, pos: str, reach: int, block_rows: int = LONG_BLOCK_ROWS) -> DataFrame:
    """Blocks of ``block_rows`` rows, each led by the ``reach`` rows before it.

    Adds ``_block`` and ``_home`` (whether the row belongs to the block or is only seen by it).
    """
    size = max(block_rows, reach + 1)
    home = F.floor(F.col(pos) / F.lit(size))
    seen = F.when(F.col(pos) % size >= size - reach, F.array(home, home + 1)).otherwise(F.array(home))
    return df.withColumn("_h", home).withColumn("_block", F.explode(seen)).withColumn(
        "_home", F.col("_block") == F.col("_h")
    ).drop("_h")


def rolling_long(
    df: DataFrame, by: list[str], order: list[str], bucket: Column, rows: int, aggregates: dict[str, Column]
) -> DataFrame:
    """``aggregates`` over the last ``rows`` rows of each key, in bounded blocks."""
    numbered = positions(df, by, order, bucket, "_pos")
    blocks = overlapping_blocks(numbered, "_pos", rows - 1)
    w = Window.partitionBy(*by, "_block").orderBy("_pos").rowsBetween(-(rows - 1), 0)
    return (
        blocks.withColumns({name: agg.over(w) for name, agg in aggregates.items()})
        .filter("_home")
        .drop("_pos", "_block", "_home")
    )


def lag_long(df: DataFrame, by: list[str], order: list[str], bucket: Column, value: str, name: str) -> DataFrame:
    """Previous value per key when a key may be too long for one window."""
    numbered = positions(df, by, order, bucket, "_pos")
    blocks = overlapping_blocks(numbered, "_pos", 1)
    w = Window.partitionBy(*by, "_block").orderBy("_pos")
    return blocks.withColumn(name, F.lag(value).over(w)).filter("_home").drop("_pos", "_block", "_home")


def _alpha(span: int) -> tuple[float, float]:
    if span < 2:
        raise ValueError("span must be at least 2")
    alpha = 2.0 / (span + 1)
    return alpha, 1.0 - alpha


def _whole(columns: dict[str, tuple[str, int]]) -> Column:
    """Rows that have a value in every column."""
    return reduce(lambda a, c: a & F.col(c).isNotNull(), sorted({c for c, _ in columns.values()}), F.lit(True))


def _decay(keep: float):
    """Fold step over block totals, oldest first."""
    return lambda acc, total: acc * F.lit(keep) + total


def _after_block(name: str, q: float):
    """Fold step over blocks, oldest first: the mean after a block of ``n`` values."""
    return lambda mean, block: mean * F.pow(F.lit(q), block["n"].cast("double")) + block[name]


def with_blocks(df: DataFrame, by: str = "symbol", order: str = "trade_date") -> DataFrame:
    """``df`` with ``_blk``, the block of 256 rows a row of its series lies in; one that has it stays as it is."""
    if "_blk" in df.columns:
        return df
    return df.withColumn("_blk", F.floor((F.row_number().over(daily(by, order)) - 1) / BLOCK_ROWS).cast("int"))


def ema(df: DataFrame, columns: dict[str, tuple[str, int]], by: str = "symbol", order: str = "trade_date") -> DataFrame:
    """Exponential means ``{name: (column, span)}`` over daily bars, seeded with the first value.

    A row in which one of the columns is null is skipped: it moves no mean and shows the means so far, null
    before the first value.

    e_t = q e_{t-1} + a x_t.  Inside a block of 256 rows e_t is a running sum of x_i q^-i scaled
    back by q^t, which cannot overflow at that length; what a block starts from is folded from the totals of the
    blocks before it, of which there is one small row each.  The order (by, block, day) serves every
    window here, so however many means are asked for, rows are sorted once for the blocks and once for the means
    (``with_blocks`` shares both among several calls), and all of it stays in one partitioning by ``by``.
    """
    blocked = with_blocks(df, by, order)
    whole = _whole(columns)
    series = Window.partitionBy(by).orderBy("_blk", order)
    upto = series.rowsBetween(Window.unboundedPreceding, 0)
    run = Window.partitionBy(by, "_blk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = blocked.withColumn("_i", F.sum(whole.cast("int")).over(run) - 1)
    firsts = {f"_x0_{name}": F.first(F.when(whole, F.col(column)), ignorenulls=True).over(upto) for name, (column, _) in columns.items()}
    step = {}
    for name, (column, span) in columns.items():
        a, q = _alpha(span)
        scaled = F.coalesce(F.sum(F.when(whole, F.col(column) * F.pow(F.lit(q), -F.col("_i")))).over(run), F.lit(0.0))
        step[f"_in_{name}"] = F.lit(a) * F.pow(F.lit(q), F.col("_i").cast("double")) * scaled
    out = out.withColumns(step)
    # the last row of a block is the one before a row of the next
    last = F.lead("_blk").over(series) != F.col("_blk")
    out = out.withColumn("_last", last)
    earlier = series.rowsBetween(Window.unboundedPreceding, -1)
    total = F.struct((F.col("_i") + 1).alias("n"), *[F.col(f"_in_{n}").alias(n) for n in columns])
    out = out.withColumns({"_tot": F.collect_list(F.when(F.col("_last"), total)).over(earlier), **firsts})
    final = {}
    for name, (_, span) in columns.items():
        _, q = _alpha(span)
        carry = F.aggregate("_tot", F.col(f"_x0_{name}"), _after_block(name, q))
        final[name] = F.pow(F.lit(q), F.col("_i") + 1.0) * carry + F.col(f"_in_{name}")
    return out.withColumns(final).select(*df.columns, *columns)


def ema_long(
    df: DataFrame, columns: dict[str, tuple[str, int]], by: list[str], order: list[str], bucket: Column,
    seeds: dict[str, str] | None = None,
) -> DataFrame:
    """``ema`` for keys of any length: block totals are aggregated map-side and joined back.

    ``seeds`` names a column holding the value to continue from (null to start with the first value).
    Rows with a null are skipped as in ``ema``.

    The value a block starts from is a fold over the totals of the blocks before it.  It reads only
    as many of them as can still change a double: beyond that q^rows is exactly 0.0.
    """
    whole = _whole(columns)
    numbered = positions(df, by, order, bucket, "_p", whole)
    numbered = numbered.withColumns({"_b": F.floor(F.col("_p") / BLOCK_ROWS), "_i": F.col("_p") % BLOCK_ROWS})
    totals = []
    for name, (column, span) in columns.items():
        a, q = _alpha(span)
        gap = F.lit(BLOCK_ROWS - 1) - F.col("_i")
        start = F.coalesce(F.col(seeds[name]), F.col(column)) if seeds and name in seeds else F.col(column)
        seed = F.when(F.col("_p") == 0, F.pow(F.lit(q), F.lit(float(BLOCK_ROWS))) * start).otherwise(0.0)
        totals.append(F.sum(F.when(whole, F.lit(a) * F.pow(F.lit(q), gap.cast("double")) * F.col(column) + seed)).alias(f"_t_{name}"))
        totals.append(F.max(F.when(whole & (F.col("_p") == 0), start)).alias(f"_x0_{name}"))
    numbered = numbered.withColumn("_key", F.struct(*by, "_b"))
    blocks = numbered.groupBy("_key").agg(*totals)
    same, block = [F.col("_key")[c] for c in by], F.col("_key._b")
    carried = {}
    for name, (_, span) in columns.items():
        _, q = _alpha(span)
        keep = q**BLOCK_ROWS
        reach = max(1, math.ceil(745.0 / (-math.log(q) * BLOCK_ROWS)) + 1)
        before = Window.partitionBy(*same).orderBy(block).rowsBetween(-reach, -1)
        fold = F.aggregate(
            F.collect_list(f"_t_{name}").over(before), F.lit(0.0), _decay(keep)
        )
        carried[f"_c_{name}"] = F.when(block == 0, F.col(f"_x0_{name}")).otherwise(fold)
    starts = blocks.withColumns(carried).select("_key", *carried)
    # a skipped row has the number of the row before it, so both must be in its frame
    run = Window.partitionBy("_key").orderBy("_p").rangeBetween(Window.unboundedPreceding, 0)
    final = {}
    for name, (column, span) in columns.items():
        a, q = _alpha(span)
        scaled = F.sum(F.when(whole, F.col(column) * F.pow(F.lit(q), -F.col("_i")))).over(run)
        inside = F.lit(a) * F.pow(F.lit(q), F.col("_i").cast("double")) * scaled
        final[name] = F.pow(F.lit(q), F.col("_i") + 1.0) * F.col(f"_c_{name}") + inside
    return numbered.join(starts, "_key").withColumns(final).select(*df.columns, *columns)
