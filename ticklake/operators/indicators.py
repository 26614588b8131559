"""Technical indicators over daily bars (one row per symbol and trade_date)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticklake.operators.series import daily, ema, with_blocks


MAX_SERVING_PERIOD = 200


def sma(df: DataFrame, windows=(5, 20), column: str = "close", partial: bool = False) -> DataFrame:
    """Simple means of the last n rows; null until n rows exist unless ``partial``.

    The serving variant (``partial``) accepts periods from 1 to 200.
    """
    if partial and any(not 1 <= n <= MAX_SERVING_PERIOD for n in windows):
        raise ValueError(f"period must lie between 1 and {MAX_SERVING_PERIOD}")
    cols = {}
    for n in windows:
        w = daily().rowsBetween(-(n - 1), 0)
        mean = F.avg(column).over(w)
        cols[f"sma_{n}"] = mean if partial else F.when(F.count(column).over(w) == n, mean)
    return df.withColumns(cols)


def emas(df: DataFrame, spans=(12, 26), column: str = "close") -> DataFrame:
    return ema(df, {f"ema_{n}": (column, n) for n in spans})


def gains_losses(df: DataFrame, column: str = "close") -> DataFrame:
    """Gain and loss against the last value before; the first value has neither, a row without one has nulls."""
    before = F.last(column, ignorenulls=True).over(daily().rowsBetween(Window.unboundedPreceding, -1))
    diff = F.when(F.col(column).isNotNull(), F.coalesce(F.col(column) - before, F.lit(0.0)))
    return df.withColumn("_d", diff).withColumns(
        {
            "gain": F.when(F.col("_d") > 0, F.col("_d")).when(F.col("_d").isNotNull(), 0.0),
            "loss": F.when(F.col("_d") < 0, -F.col("_d")).when(F.col("_d").isNotNull(), 0.0),
        }
    ).drop("_d")


def rsi_smoothed(df: DataFrame, n: int = 14) -> DataFrame:
    """Relative strength from exponential means; null while there has been no loss."""
    out = ema(gains_losses(df), {"_g": ("gain", n), "_l": ("loss", n)})
    rsi = F.when(F.col("_l") > 0, 100.0 - 100.0 / (1.0 + F.col("_g") / F.col("_l")))
    return out.withColumn(f"rsi_{n}", rsi).drop("_g", "_l", "gain", "loss")


def rsi_simple(df: DataFrame, n: int = 14) -> DataFrame:
    """Relative strength from plain means over up to n rows; 100 while there has been no loss."""
    w = daily().rowsBetween(-(n - 1), 0)
    out = gains_losses(df).withColumns({"_g": F.avg("gain").over(w), "_l": F.avg("loss").over(w)})
    rsi = F.when(F.col("_l") == 0, 100.0).otherwise(100.0 - 100.0 / (1.0 + F.try_divide("_g", "_l")))
    return out.withColumn(f"rsi_{n}", rsi).drop("_g", "_l", "gain", "loss")


FEATURE_COLUMNS = ["symbol", "trade_date", "close", "sma_5", "sma_20", "ema_12", "ema_26", "rsi_14"]


def features(df: DataFrame, version: str, stamp_ms: int) -> DataFrame:
    """The standard feature table; every window shares the partitioning by symbol."""
    missing = [c for c in ("symbol", "trade_date", "close") if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    base = gains_losses(sma(df.select("symbol", "trade_date", "close")))
    out = ema(
        base, {"ema_12": ("close", 12), "ema_26": ("close", 26), "_g": ("gain", 14), "_l": ("loss", 14)}
    ).withColumn("rsi_14", F.when(F.col("_l") > 0, 100.0 - 100.0 / (1.0 + F.col("_g") / F.col("_l"))))
    return out.select(
        *FEATURE_COLUMNS,
        F.lit(version).alias("feature_version"),
        F.lit(stamp_ms).cast("bigint").alias("feature_timestamp"),
    )


def features_wide(df: DataFrame, version: str, stamp_ms: int) -> DataFrame:
    """Every column of the wide feature table, for bars with high, low, close and volume."""
    out = sma(df, windows=(5, 10, 20, 50, 100, 200))
    out = with_blocks(obv(vwap(atr(stochastic(bollinger(gains_losses(out)))))))
    out = ema(out, {f"ema_{n}": ("close", n) for n in (12, 26, 50)})
    out = out.withColumn("macd", F.col("ema_12") - F.col("ema_26"))
    out = ema(out, {"macd_signal": ("macd", 9), "_g": ("gain", 14), "_l": ("loss", 14)})
    rsi = F.when(F.col("_l") > 0, 100.0 - 100.0 / (1.0 + F.col("_g") / F.col("_l")))
    return out.withColumns(
        {
            "macd_histogram": F.col("macd") - F.col("macd_signal"),
            "rsi_14": rsi,
            "feature_version": F.lit(version),
            "feature_timestamp": F.lit(stamp_ms).cast("bigint"),
        }
    ).drop("_g", "_l", "gain", "loss", "_blk")


def macd(df: DataFrame) -> DataFrame:
    """EMA12 - EMA26, its EMA9 signal and their difference."""
    out = emas(with_blocks(df)).withColumn("macd", F.col("ema_12") - F.col("ema_26"))
    out = ema(out, {"macd_signal": ("macd", 9)})
    return out.withColumn("macd_histogram", F.col("macd") - F.col("macd_signal")).drop("ema_12", "ema_26", "_blk")


def bollinger(df: DataFrame, n: int = 20, width: float = 2.0) -> DataFrame:
    """Mean of n rows ± width population deviations; bb_width is the band in % of the mean."""
    w = daily().rowsBetween(-(n - 1), 0)
    full = F.count("close").over(w) == n
    mid, dev = F.avg("close").over(w), F.stddev_pop("close").over(w)
    return df.withColumns({"_m": F.when(full, mid), "_s": F.when(full, dev)}).withColumns(
        {
            "bb_middle": F.col("_m"),
            "bb_upper": F.col("_m") + width * F.col("_s"),
            "bb_lower": F.col("_m") - width * F.col("_s"),
            "bb_width": 2 * width * F.col("_s") / F.col("_m") * 100,
        }
    ).drop("_m", "_s")


def stochastic(df: DataFrame, n: int = 14, smooth: int = 3) -> DataFrame:
    """%K = (close - lowest low) / (highest high - lowest low) · 100, %D = mean of %K over 3 rows."""
    w = daily().rowsBetween(-(n - 1), 0)
    lo, hi = F.min("low").over(w), F.max("high").over(w)
    out = df.withColumn("stochastic_k", F.try_divide(F.col("close") - lo, hi - lo) * 100)
    return out.withColumn("stochastic_d", F.avg("stochastic_k").over(daily().rowsBetween(-(smooth - 1), 0)))


def atr(df: DataFrame, n: int = 14) -> DataFrame:
    """Mean true range over n rows, null until n rows exist."""
    prev = F.lag("close").over(daily())
    tr = F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - prev), F.abs(F.col("low") - prev))
    w = daily().rowsBetween(-(n - 1), 0)
    out = df.withColumn("_tr", tr)
    return out.withColumn(f"atr_{n}", F.when(F.count("_tr").over(w) == n, F.avg("_tr").over(w))).drop("_tr")


def vwap(df: DataFrame, n: int = 20) -> DataFrame:
    """Typical price weighted by volume over n rows."""
    w = daily().rowsBetween(-(n - 1), 0)
    typical = (F.col("high") + F.col("low") + F.col("close")) / 3
    return df.withColumn("vwap", F.try_divide(F.sum(typical * F.col("volume")).over(w), F.sum("volume").over(w)))


def obv(df: DataFrame) -> DataFrame:
    """Running volume signed by the direction of the close."""
    change = F.signum(F.col("close") - F.lag("close").over(daily()))
    out = df.withColumn("_s", F.coalesce(change, F.lit(0.0)).cast("bigint") * F.col("volume"))
    return out.withColumn(
        "obv", F.sum("_s").over(daily().rowsBetween(Window.unboundedPreceding, 0))
    ).drop("_s")


def rsi_signal(c):
    """Overbought above 70, oversold below 30."""
    return F.when(c > 70, "Overbought").when(c < 30, "Oversold").otherwise("Neutral")


def trend_signal(fast, mid, slow):
    return (
        F.when((fast > mid) & (mid > slow), "Bullish").when((fast < mid) & (mid < slow), "Bearish").otherwise("Neutral")
    )


def band_regime(width):
    return F.when(width < 20, "Consolidating").when(width > 40, "Volatile").otherwise("Normal")
