"""Chart-ready tables (C1-C4): the data behind each plot, ordered as it would be drawn."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barframe.operators.aggregate import series_keys


def close_by_year(yearly: DataFrame) -> DataFrame:
    """One line per ticker: mean close by year (C1, sorted by ticker, year)."""
    return yearly.select("ticker", "year", "avg_close").orderBy("ticker", "year")


def volatility_by_ticker(yearly: DataFrame) -> DataFrame:
    """One line per year: mean volatility by ticker (C2, sorted by year, ticker)."""
    return yearly.select("year", "ticker", "avg_volatility").orderBy("year", "ticker")


def close_history(bars: DataFrame) -> DataFrame:
    """Close history of every series (C3) — column-pruned to what the chart draws, sorted by date."""
    keys = series_keys(bars)
    return bars.select(*keys, "date", "close").orderBy(*keys, "date")


def actual_vs_predicted(predictions: DataFrame) -> DataFrame:
    """Actual vs predicted per series and date (C4)."""
    keys = series_keys(predictions)
    return predictions.select(*keys, "date", "actual", "predicted").orderBy(*keys, "date")


def chart_points(bars: DataFrame, column: str = "close", *, width: int = 1000) -> DataFrame:
    """The points that draw a series' history on ``width`` pixel columns as all of them would.

    Of each series and pixel column: the first, last, lowest and highest point (of equal values the earliest), so at most
    4 * ``width`` rows a series however long it is, with its extremes kept. ``keys, pixel, date, <column>``, unsorted: a
    chart sorts what it gets. A series' first date lies in pixel 0 and its last in ``width`` - 1. Rows without a date or a
    finite value are left out; of several rows with one date the smallest and largest values are points. Two aggregations
    with partial results, no window and no global sort: a series that holds most rows needs no larger task than others.
    """
    if width < 1:
        raise ValueError("width must be positive")
    keys = series_keys(bars)
    value = F.col(column).cast("double")
    finite = F.col("date").isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))
    rows = bars.where(finite).select(*keys, "date", value.alias("value"))
    span = rows.groupBy(*keys).agg(F.min("date").alias("first"), F.max("date").alias("last"))
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    placed = rows.alias("r").join(span.alias("s"), same).select(*[F.col(f"r.{k}").alias(k) for k in keys], "date", "value", "first", "last")
    days = F.date_diff("last", "first") + 1
    pixel = F.floor(F.date_diff("date", "first").cast("bigint") * F.lit(int(width)) / days).cast("int")
    # A span of fewer days than pixels leaves gaps; its last day still belongs to the last pixel.
    pixel = F.when((F.col("date") == F.col("last")) & (F.col("first") < F.col("last")), F.lit(int(width) - 1)).otherwise(pixel)
    early = -F.unix_date("date")
    points = placed.groupBy(*keys, pixel.alias("pixel")).agg(
        F.min(F.struct("date", "value")).alias("a"), F.max(F.struct("date", "value")).alias("b"),
        F.min(F.struct("value", "date")).alias("c"), F.max(F.struct("value", early.alias("early"), "date")).alias("d"),
    )
    chosen = F.array(*[F.struct(F.col(f"{p}.date").alias("date"), F.col(f"{p}.value").alias("value")) for p in "abcd"])
    return points.select(*keys, "pixel", F.explode(F.array_distinct(chosen)).alias("p")).select(
        *keys, "pixel", F.col("p.date").alias("date"), F.col("p.value").alias(column)
    )
