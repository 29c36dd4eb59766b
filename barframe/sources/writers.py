"""Sinks (K1-K5).

Partitioned writes go through a ``rebalance`` hint on the partition columns: adaptive execution
then splits skewed write partitions (a ticker holding a third of all rows is written by many
tasks) and coalesces tiny ones, instead of the fixed ``repartition(10)`` of a one-machine setup.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: ISO date layout of the landed records ("2000-01-03T00:00:00.000").
ISO_DATETIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS"


# Rows of one array: a series' calendar year.
CHUNK = "year"


def _rebalanced(df: DataFrame, partition_by: Sequence[str] | None) -> DataFrame:
    return df.hint("rebalance", *partition_by) if partition_by else df


def write_parquet(
    df: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
) -> None:
    """Parquet sink: ``mode='overwrite'`` (K1) or ``'errorifexists'`` (K2), optionally partitioned (``year``)."""
    w = _rebalanced(df, partition_by).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def landed_records(df: DataFrame) -> DataFrame:
    """Canonical bars -> the landed record layout (``Date`` ISO text, ``Open … Volume``), keys kept."""
    keys = [c for c in ("ticker", "copy_id") if c in df.columns]
    return df.select(
        *keys,
        F.date_format(F.col("date").cast("timestamp"), ISO_DATETIME_FORMAT).alias("Date"),
        F.col("open").alias("Open"),
        F.col("high").alias("High"),
        F.col("low").alias("Low"),
        F.col("close").alias("Close"),
        F.col("volume").alias("Volume"),
    )


def write_line_json(
    df: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = ("ticker",),
    landed: bool = True,
) -> None:
    """Line-JSON sink (K3, U2): one write for every ticker and copy, in a folder for each ticker.

    ``copy_id`` stays a field of the records, so the number of folders does not grow with the
    copies; the reader takes it from there.

    ``landed=True`` writes the landed record layout, so the files read back with the same
    reader as the original landing; ``False`` writes the frame's columns as they are.
    """
    if landed and "date" in df.columns:
        df = landed_records(df)
    partition_by = [c for c in (partition_by or []) if c in df.columns]
    w = _rebalanced(df, partition_by).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.json(path)


def to_json_records(df: DataFrame, keys: Sequence[str] | None = None, *, chunk: str | None = CHUNK) -> DataFrame:
    """JSON arrays of records, dates in ISO format, sorted by date (K5): one per series and year.

    Output: ``keys..., json``. An array holds one element per trading day of its year, so a group
    is bounded by the calendar year however long the series is. ``chunk=None`` makes one array of a
    whole series.
    """
    if keys is None:
        keys = [c for c in ("ticker", "copy_id") if c in df.columns]
    rec = F.struct(
        F.date_format(F.col("date").cast("timestamp"), ISO_DATETIME_FORMAT).alias("Date"),
        F.col("open").alias("Open"),
        F.col("high").alias("High"),
        F.col("low").alias("Low"),
        F.col("close").alias("Close"),
        F.col("volume").alias("Volume"),
    )
    chunks = [F.year("date").alias("_chunk")] if chunk == CHUNK else []
    return df.groupBy(*keys, *chunks).agg(F.to_json(F.array_sort(F.collect_list(rec))).alias("json")).drop("_chunk")


def write_json_arrays(df: DataFrame, path: str, *, mode: str = "overwrite", keys: Sequence[str] | None = None) -> None:
    """Landing layout: a JSON array per file, series and year, in Hive folders ``ticker=…/[copy_id=…/]`` (K5 + K4)."""
    recs = to_json_records(df, keys)
    keys = [c for c in recs.columns if c != "json"]
    _rebalanced(recs, keys).write.mode(mode).option("maxRecordsPerFile", 1).partitionBy(*keys).text(path)


def write_text(df: DataFrame, path: str, column: str, *, mode: str = "overwrite", partition_by: Sequence[str] | None = None) -> None:
    """Text sink (K4): one line per row of the string ``column``."""
    partition_by = list(partition_by or [])
    w = df.select(*partition_by, F.col(column).cast("string").alias("value")).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.text(path)


def write_wrapped_json(df: DataFrame, path: str, *, mode: str = "overwrite", column: str = "json_string") -> None:
    """The "wrapped" landing: line JSON records whose ``column`` holds a series' year as a JSON string."""
    recs = to_json_records(df).withColumnRenamed("json", column)
    keys = [c for c in recs.columns if c != column]
    _rebalanced(recs, keys).write.mode(mode).partitionBy(*keys).json(path)


def write_bucketed_bars(
    df: DataFrame, table: str, path: str, *, buckets: int, keys: Sequence[str] | None = None, mode: str = "overwrite"
) -> None:
    """Bar table bucketed by the series keys and sorted by date inside each bucket (an external
    table at ``path``, registered in the session catalog as ``table``).

    Every later window over the series (indicators, scaling, sequences, split) then reads
    partitions that are already hash-partitioned on the keys, so its exchange disappears: the
    partitioning is paid once at write time and reused by every modelling run. The rows are dealt
    out by bucket first, so that a bucket is one file however many tasks made the rows.
    """
    if keys is None:
        keys = [c for c in ("ticker", "copy_id") if c in df.columns]
    (
        df.repartition(int(buckets), *keys)
        .write.mode(mode)
        .option("path", path)
        .bucketBy(int(buckets), keys[0], *keys[1:])
        .sortBy(keys[0], *keys[1:], "date")
        .format("parquet")
        .saveAsTable(table)
    )
