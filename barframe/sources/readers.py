"""Readers for landed bars (S1-S4, J1, P1, P2, P4) and the report of their files.

All readers take an explicit schema (no inference pass over every file) and return the
canonical bar layout ``ticker, [copy_id,] date, open, high, low, close, volume, source``.
Ticker and copy come from the records if they carry them, else from the data path (Hive partition
or file name), never from a loop literal.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barframe.functions.expressions import ticker_from_path, to_bar_date
from barframe.schema import LANDED_SCHEMA, RAW_BAR_ARRAY_DDL, VALUE_COLUMNS

_COPY_FROM_PATH = r"/[^/]+?_([0-9]+|original)\.json(?:/|$)"
_HIVE_COPY = r"/copy_id=([0-9]+)(?:/|$)"


def copy_from_path(path_col) -> F.Column:
    """Copy number from a path: ``copy_id=<n>`` directory, ``_<n>.json`` (n) or ``_original.json`` (0)."""
    p = F.col(path_col) if isinstance(path_col, str) else path_col
    hive = F.regexp_extract(p, _HIVE_COPY, 1)
    named = F.regexp_extract(p, _COPY_FROM_PATH, 1)
    return (
        F.when(hive != "", hive.cast("int"))
        .when(named == "original", F.lit(0))
        .when(named != "", named.cast("int"))
    )


def normalize_landed(df: DataFrame, source_col: str | None = "source", *, records_first: bool = False) -> DataFrame:
    """Landed records (``Date, Open, High, Low, Close, Volume``) -> canonical lower-case bars.

    ``ticker``/``copy_id`` are parsed from ``source_col`` (the file path) when it is present —
    Hive folders or file names, so partition-type inference never turns a ticker like ``007``
    into a number — and fall back to same-named data columns. ``records_first`` turns that order
    round, for a scan whose ``ticker`` and ``copy_id`` are fields of the records. Column lookup is
    case-insensitive.
    """
    cols = {c.lower(): c for c in df.columns}
    src = F.col(cols[source_col.lower()]) if source_col and source_col.lower() in cols else None
    ticker_parts = [ticker_from_path(src)] if src is not None else []
    if "ticker" in cols:
        ticker_parts.append(F.col(cols["ticker"]).cast("string"))
    if records_first:
        ticker_parts.reverse()
    out = [(F.coalesce(*ticker_parts) if ticker_parts else F.lit(None).cast("string")).alias("ticker")]
    copy_parts = [copy_from_path(src)] if src is not None else []
    if "copy_id" in cols:
        copy_parts.append(F.col(cols["copy_id"]).cast("int"))
    if records_first:
        copy_parts.reverse()
    if copy_parts:
        out.append(F.coalesce(*copy_parts, F.lit(0)).alias("copy_id"))
    out.append(to_bar_date(F.col(cols["date"])).alias("date"))
    for name in ("open", "high", "low", "close", "volume"):
        if name in cols:
            out.append(F.col(cols[name]).cast("double").alias(name))
        else:
            out.append(F.lit(None).cast("double").alias(name))
    if src is not None:
        out.append(src.alias("source"))
    return df.select(*out)


@contextmanager
def listed_in_blocks(spark: SparkSession) -> Iterator[None]:
    """Scans made inside list their folders in a few tasks for each core, not in a task for each folder (up to 10,000)."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _with_source(df: DataFrame) -> DataFrame:
    return df.withColumn("source", F.col("_metadata.file_path"))


def read_bars_json(
    spark: SparkSession,
    path: str | list[str],
    *,
    multiline: bool = False,
    schema: T.StructType = LANDED_SCHEMA,
) -> DataFrame:
    """Scan landed JSON bars (S1 with ``multiline=True`` for array files, S2/S3 for line JSON).

    ``path`` may be a folder, a glob over every ticker (``raw/*_*.json``) or a list of paths:
    one scan covers all tickers and copies, instead of one job per ticker. A multi-line file is
    parsed whole by one task (it cannot be split), so large landings should be line JSON — which
    is what ``write_line_json`` produces — and split at ``spark.sql.files.maxPartitionBytes``.
    """
    # Folders of any layout below the path are read; they give no columns of their own.
    with listed_in_blocks(spark):
        raw = spark.read.schema(schema).option("multiLine", multiline).option("recursiveFileLookup", True).json(path)
    return normalize_landed(_with_source(raw), records_first=True)


_CORRUPT = "_corrupt_record"


def checked_records(spark: SparkSession, path: str | list[str], *, multiline: bool = False) -> DataFrame:
    """Every landed record with its file and what is wrong with it.

    ``source, ticker, record, problem, complete``: ``problem`` is ``malformed`` (no JSON of the
    landed layout; its text is in ``record``), ``date`` (no readable date) or NULL; ``complete``
    tells whether all five values are there.
    """
    schema = T.StructType([*LANDED_SCHEMA.fields, T.StructField(_CORRUPT, T.StringType())])
    with listed_in_blocks(spark):
        raw = (
            spark.read.schema(schema).option("multiLine", multiline).option("recursiveFileLookup", True)
            .option("columnNameOfCorruptRecord", _CORRUPT).json(path)
        )
    source = F.col("_metadata.file_path")
    complete = F.lit(True)
    for c in VALUE_COLUMNS:
        complete = complete & F.col(c.capitalize()).isNotNull()
    problem = F.when(F.col(_CORRUPT).isNotNull(), "malformed").when(to_bar_date(F.col("Date")).isNull(), "date")
    return raw.select(
        source.alias("source"), F.coalesce("ticker", ticker_from_path(source)).alias("ticker"), F.col(_CORRUPT).alias("record"),
        problem.alias("problem"), complete.alias("complete"),
    )


def file_report(spark: SparkSession, path: str | list[str], *, multiline: bool = False) -> DataFrame:
    """One row per landed file: its records, the faulty ones, and a status.

    Status: ``ok``; ``empty`` (no record); ``faulty`` (some records malformed or without a date);
    ``broken`` (no readable record at all). One aggregation by file; the files themselves are
    listed without reading their contents, so that one of blank lines has a row as well. Spark's
    scans skip files of zero bytes: their tickers appear as ``no data`` in the coverage report.
    """
    n = lambda cond: F.count(F.when(cond, F.lit(1)))
    counts = checked_records(spark, path, multiline=multiline).groupBy("source").agg(
        F.count(F.lit(1)).alias("n_records"),
        n(F.col("problem") == "malformed").alias("n_malformed"),
        n(F.col("problem") == "date").alias("n_no_date"),
        n(F.col("problem").isNull() & ~F.col("complete")).alias("n_incomplete"),
    )
    with listed_in_blocks(spark):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    listed = files.select(F.col("_metadata.file_path").alias("source"), F.col("length").alias("n_bytes"))
    out = listed.join(counts, "source", "left").na.fill(0, ["n_records", "n_malformed", "n_no_date", "n_incomplete"])
    faulty = F.col("n_malformed") + F.col("n_no_date")
    status = (
        F.when(F.col("n_records") == 0, "empty").when(faulty == F.col("n_records"), "broken").when(faulty > 0, "faulty").otherwise("ok")
    )
    return out.withColumns({"ticker": ticker_from_path("source"), "status": status})


def read_wrapped_json(spark: SparkSession, path: str | list[str], *, column: str = "json_string", text: bool = False) -> DataFrame:
    """Unwrap bars stored as a JSON array *string*.

    ``text=False``: line JSON whose records hold the array in ``column`` (one record per copy);
    ``text=True``: plain text files with one whole array per line. Each string is parsed with an
    explicit array-of-struct schema and exploded into rows; each string holds one series, so its
    size is bounded by the number of trading days.
    """
    with listed_in_blocks(spark):
        if text:
            raw = spark.read.text(path).withColumnRenamed("value", column)
        else:
            raw = spark.read.schema(T.StructType([T.StructField(column, T.StringType())])).json(path)
    raw = _with_source(raw)
    extra = [c for c in raw.columns if c not in (column, "source")]
    rows = raw.select(*extra, "source", F.explode(F.from_json(F.col(column), RAW_BAR_ARRAY_DDL)).alias("r"))
    return normalize_landed(rows.select(*extra, "source", "r.*"))


def read_bars_parquet(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan (S4); filters and projections applied later reach the scan as pushed filters.

    Passing the ``schema`` the table was written with skips the footer inference and also reads
    a table that received no rows.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*([path] if isinstance(path, str) else path))
