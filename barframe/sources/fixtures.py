"""Stand-in daily bars derived from the driver tables (FIXTURES.md §2).

Each fixture is a plain aggregate over one fact table, grouped by (ticker, date):

* open / close = the price at the first / last row in a deterministic order key
  (``min_by`` / ``max_by`` over a unique packed order key, so ties are impossible),
* high / low   = max / min price,
* volume       = summed quantity (or the row count).

``min_by``/``max_by``/``min``/``max``/``sum`` are all partially aggregatable, so the plan is a
partial ``HashAggregate`` on every input split, one shuffle on (ticker, date), and a final
aggregate — a hot ticker is collapsed map-side before it reaches the exchange.

The order key is packed into one ``decimal(38,0)`` (each part in its own block of digits) rather
than a struct: a struct ordering makes the aggregation buffer variable-width and forces a
sort-based aggregate, while a decimal buffer keeps the hash aggregate.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def packed_key(*parts: tuple[Column, int]) -> Column:
    """Lexicographic order of non-negative integer ``parts`` as one ``decimal(38,0)``.

    Each part is ``(column, digits)``; a part must stay below ``10**digits`` and the digits must
    sum to at most 38.
    """
    if sum(d for _, d in parts) > 38:
        raise ValueError("packed key wider than 38 digits")
    key = None
    for col, digits in parts:
        c = col.cast("decimal(38,0)")
        key = c if key is None else key * F.lit(Decimal(10**digits)).cast("decimal(38,0)") + c
    return key.cast("decimal(38,0)")


def _bars(src: DataFrame, ticker: Column, ts: Column, price: Column, order_key: Column, volume: Column) -> DataFrame:
    return (
        src.groupBy(ticker.alias("ticker"), ts.cast("date").alias("date"))
        .agg(
            F.min_by(price, order_key).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, order_key).alias("close"),
            volume.cast("double").alias("volume"),
        )
    )


def _lineitem_key() -> Column:
    """(l_orderkey, l_linenumber, l_extendedprice): 21 + 17 digits (price in cents).

    The first two parts are combined in BIGINT arithmetic (orderkey below 9.2e15, line below
    1000), leaving a single decimal multiply-add per row.
    """
    cents = F.round(F.col("l_extendedprice") * F.lit(100)).cast("decimal(38,0)")
    order_line = F.col("l_orderkey") * F.lit(1000) + F.col("l_linenumber")
    return packed_key((order_line, 21), (cents, 17))


def _events_key() -> Column:
    """(ts, event_id) within one day: microseconds since midnight (11 digits) + event id (19 digits)."""
    ts = F.col("ts")
    micros = (F.hour(ts) * F.lit(3600) + F.minute(ts) * F.lit(60)).cast("decimal(38,0)") * F.lit(1000000) + (
        F.date_part(F.lit("SECOND"), ts) * F.lit(1000000)
    ).cast("decimal(38,0)")
    return packed_key((micros, 11), (F.col("event_id"), 19))


def bars_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three long series (ticker = return flag), seven years of daily bars."""
    li = _table(spark, sf_dir, "lineitem")
    return _bars(li, F.col("l_returnflag"), F.col("l_shipdate"), F.col("l_extendedprice"), _lineitem_key(), F.sum("l_quantity"))


def bars_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many sparse series (ticker = supplier key as text); grows with the scale factor."""
    li = _table(spark, sf_dir, "lineitem")
    return _bars(
        li, F.col("l_suppkey").cast("string"), F.col("l_shipdate"), F.col("l_extendedprice"), _lineitem_key(), F.sum("l_quantity")
    )


def bars_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five short dense series (ticker = event type), one month of bars."""
    ev = _table(spark, sf_dir, "events")
    return _bars(ev, F.col("event_type"), F.col("ts"), F.col("value"), _events_key(), F.count(F.lit(1)))


def expected_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The supplier dimension as the list of tickers that *should* have bars (for coverage reports)."""
    return _table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("ticker"))


FIXTURES = {
    "lineitem": bars_lineitem,
    "supplier": bars_supplier,
    "events": bars_events,
}
