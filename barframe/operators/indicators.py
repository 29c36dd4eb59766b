"""Rolling indicators for every series at once.

All windows share one spec, ``partitionBy(series keys).orderBy(date)``, so the whole indicator
frame costs one exchange on the series keys and one sort; the lags are computed first and the
frames that use them in a second ``Window`` over the already-sorted rows.

Scale note: a window partition is one series, i.e. one (ticker, copy) — bounded by the number of
trading days, not by the table size. Many series spread over all tasks; a ticker with many
copies is many partitions, because ``copy_id`` is part of the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barframe.functions.expressions import full_window_mean, pct_change, safe_div, volatility_ratio
from barframe.operators.aggregate import series_keys
from barframe.operators.clean import drop_incomplete

# Indicator names and periods.
MOVING_AVERAGES = (("ma5", 5), ("ma20", 20))
RSI_PERIOD = 14
RAW_FEATURES = ["open", "high", "low", "close", "volume"]
DERIVED_FEATURES = ["ma5", "ma20", "price_change", "price_change_5d", "volume_change", "volatility", "rsi"]
FEATURES = RAW_FEATURES + DERIVED_FEATURES


def series_window(df: DataFrame, keys: Sequence[str] | None = None, order: str = "date") -> WindowSpec:
    keys = list(keys) if keys is not None else series_keys(df)
    return Window.partitionBy(*keys).orderBy(order)


def add_moving_averages(df: DataFrame, column: str = "close", windows=MOVING_AVERAGES, keys=None) -> DataFrame:
    """Trailing means that are NULL until the window is full."""
    w = series_window(df, keys)
    return df.withColumns({name: full_window_mean(column, w, n) for name, n in windows})


def add_price_changes(df: DataFrame, keys=None) -> DataFrame:
    """``price_change`` (1 row), ``price_change_5d`` (5 rows), ``volume_change``.

    A zero or missing base gives NULL rather than an infinity.
    """
    w = series_window(df, keys)
    return df.withColumns(
        {
            "price_change": pct_change("close", w, 1),
            "price_change_5d": pct_change("close", w, 5),
            "volume_change": pct_change("volume", w, 1),
        }
    )


def add_rsi(df: DataFrame, column: str = "close", period: int = RSI_PERIOD, keys=None) -> DataFrame:
    """Relative strength index with simple moving means of gains and losses.

    The first difference of a series counts as 0 (no gain, no loss), so the first value appears
    on row ``period``. Mean loss 0 with mean gain > 0 gives 100; both 0 gives NULL.
    """
    w = series_window(df, keys)
    delta = F.col(column) - F.lag(column, 1).over(w)
    with_delta = df.withColumn("_delta", delta)
    gain = F.greatest(F.col("_delta"), F.lit(0.0))  # NULL first delta -> 0 (greatest skips NULL)
    loss = F.greatest(-F.col("_delta"), F.lit(0.0))
    with_means = with_delta.withColumns(
        {"_gain": full_window_mean(gain, w, period), "_loss": full_window_mean(loss, w, period)}
    )
    rsi = (
        F.when(F.col("_loss") == 0, F.when(F.col("_gain") > 0, F.lit(100.0)))
        .otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + safe_div("_gain", "_loss")))
    )
    return with_means.withColumn("rsi", rsi).drop("_delta", "_gain", "_loss")


def indicators(df: DataFrame, *, dropna: bool = True, keys=None) -> DataFrame:
    """Indicator frame (W10): raw five + ma5, ma20, price_change, price_change_5d, volume_change,
    volatility, rsi; rows with any missing feature removed when ``dropna``.
    """
    out = add_moving_averages(df, keys=keys)
    out = add_price_changes(out, keys=keys)
    out = out.withColumn("volatility", volatility_ratio())
    out = add_rsi(out, keys=keys)
    return drop_incomplete(out, subset=FEATURES) if dropna else out
