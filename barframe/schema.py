"""Canonical bar schema and column checks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Canonical bar table: one row per (ticker, copy_id, date). copy_id is optional (0 = original).
BAR_SCHEMA = T.StructType(
    [
        T.StructField("ticker", T.StringType(), True),
        T.StructField("date", T.DateType(), True),
        T.StructField("open", T.DoubleType(), True),
        T.StructField("high", T.DoubleType(), True),
        T.StructField("low", T.DoubleType(), True),
        T.StructField("close", T.DoubleType(), True),
        T.StructField("volume", T.DoubleType(), True),
    ]
)
BAR_COLUMNS = [f.name for f in BAR_SCHEMA.fields]
PRICE_COLUMNS = ["open", "high", "low", "close"]
VALUE_COLUMNS = PRICE_COLUMNS + ["volume"]

# Landed records as written by the downloader: capitalised names, ISO date strings
# such as "2000-01-03T00:00:00.000", prices as doubles. Reading with this schema avoids
# the inference pass over every file.
RAW_BAR_SCHEMA = T.StructType(
    [
        T.StructField("Date", T.StringType(), True),
        T.StructField("Open", T.DoubleType(), True),
        T.StructField("High", T.DoubleType(), True),
        T.StructField("Low", T.DoubleType(), True),
        T.StructField("Close", T.DoubleType(), True),
        T.StructField("Volume", T.DoubleType(), True),
    ]
)

# As read: the records may carry their own ticker and copy number (merged landings do).
LANDED_SCHEMA = T.StructType(
    [*RAW_BAR_SCHEMA.fields, T.StructField("ticker", T.StringType(), True), T.StructField("copy_id", T.IntegerType(), True)]
)

# JSON array of landed records held in one string column (the "wrapped" landing).
RAW_BAR_ARRAY_DDL = "array<struct<Date:string,Open:double,High:double,Low:double,Close:double,Volume:double>>"


class MissingColumnsError(ValueError):
    """Raised by ``require_columns`` when a DataFrame lacks required columns."""


def has_columns(df: DataFrame, columns: Iterable[str]) -> bool:
    """Soft check (F5): True when every column is present (case-insensitive, like Spark's resolver)."""
    present = {c.lower() for c in df.columns}
    return all(c.lower() in present for c in columns)


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Hard check (F4): raise ``MissingColumnsError`` naming the first missing column; else return ``df``."""
    present = {c.lower() for c in df.columns}
    missing = [c for c in columns if c.lower() not in present]
    if missing:
        raise MissingColumnsError(f"missing column: {missing[0]} (all missing: {missing})")
    return df


def flatten_column_name(name) -> str:
    """Tuple-style header ``("Close", "AAPL")`` -> ``"Close"`` (S8); plain names unchanged."""
    if isinstance(name, tuple):
        return str(name[0])
    return str(name)


def flatten_columns(df: DataFrame, names: Sequence | None = None) -> DataFrame:
    """Rename columns to the first element of tuple-style names.

    Spark column names are strings, so tuple headers arrive either as explicit ``names``
    (from a multi-level source header) or as nested structs; in both cases ``toDF`` renames
    positionally without touching data.
    """
    names = list(names) if names is not None else list(df.columns)
    return df.toDF(*[flatten_column_name(n) for n in names])


def schema_report(df: DataFrame) -> list[tuple[str, str, bool]]:
    """``printSchema`` as data (K9): (column, type, nullable) for each top-level field."""
    return [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]


def schema_rows(df: DataFrame) -> DataFrame:
    """The schema as rows, with what the columns hold (K9): ``position`` (from 0), ``name, type, nullable, n_rows, n_null``.

    One aggregation over all columns; a frame without columns has no rows.
    """
    if not df.columns:
        return df.sparkSession.range(0).selectExpr("0 AS position", "'' AS name", "'' AS type", "true AS nullable", "0L AS n_rows", "0L AS n_null")
    flat = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    counts = flat.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(c).alias(c) for c in flat.columns])
    rows = [
        F.struct(
            F.lit(i).alias("position"), F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"),
            F.lit(f.nullable).alias("nullable"), F.col("n_rows"), (F.col("n_rows") - F.col(f"c{i}")).alias("n_null"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return counts.select(F.inline(F.array(*rows)))
