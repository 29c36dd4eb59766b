"""Compaction of landings of many small files (U2, K3): files near a target size, a manifest as commit point.

Every ticker's small files are packed into bins by their sizes, in the order of their paths: with S bytes in
all there are ceil(S / target) bins, and a file belongs to the bin in which its first byte lies when the files
are laid end to end. So a bin holds S / bins bytes, give or take one file. The lines of a bin become one file.

A manifest, kept as a table of versions, names the files that were replaced and where their lines are now. It is
written last: a run that stops before leaves the landing as it was for every reader, and what it wrote is never
read. Files landed later are read as they are until the next run. The landed files stay; whoever removes those
that the manifest names does so after the last reader of the former state.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barframe.functions.expressions import path_of_source, ticker_from_path
from barframe.plans.workspace import scratch_path
from barframe.sources.readers import copy_from_path, read_bars_json
from barframe.sources.versions import read_version, write_version

TARGET_BYTES = 128 << 20


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """``source, n_bytes`` of every file below ``path`` that holds any bytes; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.col("_metadata.file_path").alias("source"), F.col("length").alias("n_bytes"))


def _paths(files: DataFrame) -> list[str]:
    return [r["path"] for r in files.select(path_of_source("source").alias("path")).toLocalIterator()]


def pack_files(files: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """``source, n_bytes, ticker, bin`` for the files worth moving.

    Files of ``target_bytes`` or more are left where they are, and so is one that would have a bin to
    itself. A ticker's list of files is one window: a short row for each file, never their contents.
    """
    by_ticker = Window.partitionBy("ticker")
    small = files.withColumn("ticker", ticker_from_path("source")).where(F.col("n_bytes") < target_bytes)
    before = F.sum("n_bytes").over(by_ticker.orderBy("source")) - F.col("n_bytes")
    total = F.sum("n_bytes").over(by_ticker)
    bins = F.ceil(total / F.lit(target_bytes))
    packed = small.withColumns({"_before": before, "_total": total, "_bins": bins})
    packed = packed.withColumn("bin", F.floor(F.col("_before") / F.col("_total") * F.col("_bins")).cast("int"))
    several = F.count(F.lit(1)).over(Window.partitionBy("ticker", "bin")) > 1
    return packed.withColumn("_several", several).where("_several").select("source", "n_bytes", "ticker", "bin")


def with_copy(line: Column, copy: Column) -> Column:
    """A landed line with its copy number as a field; lines that have one, or are no JSON objects, stay as they are.

    The text of an object is extended, not written anew, but for one whose ``copy_id`` is no whole number: that
    field would hide the added one, so it is left out.
    """
    fields = F.try_variant_get(F.try_parse_json(line), "$", "map<string,variant>")
    own = F.try_variant_get(F.try_parse_json(line), "$.copy_id", "int")
    others = F.map_filter(fields, lambda k, _v: k != "copy_id")
    text = F.when(F.map_contains_key(fields, "copy_id"), F.to_json(others)).otherwise(line)
    rest = F.substring(F.ltrim(text), 2, 2**31 - 1)
    comma = F.when(F.ltrim(rest).startswith("}"), F.lit("")).otherwise(F.lit(","))
    extended = F.concat(F.lit('{"copy_id":'), copy.cast("string"), comma, rest)
    return F.when(fields.isNotNull() & own.isNull() & copy.isNotNull(), extended).otherwise(line)


def compact_landing(spark: SparkSession, landing: str, store: str, *, target_bytes: int = TARGET_BYTES) -> int:
    """Pack the small line-JSON files of ``landing`` that no earlier run has packed; returns how many there were.

    Every line moves as it is, readable or not; a record that does not carry its copy number gets it from its path (an
    unreadable line cannot, and counts to copy 0 from then on).
    ``store`` holds the packed files and the manifest. The list of paths (not the files) goes through the
    driver, where Spark's own listing of a scan lies as well.
    """
    if target_bytes < 1:
        raise ValueError("target_bytes must be positive")
    files, manifest = landed_files(spark, landing), read_version(spark, f"{store}/manifest")
    if manifest is not None:
        files = files.join(manifest.select("source"), "source", "left_anti")
    # The plan is written down first, so that the lines and the manifest follow the same one.
    plan_path = scratch_path(spark, "compaction-plan")
    pack_files(files, target_bytes).write.parquet(plan_path)
    plan = spark.read.schema("source string, n_bytes bigint, ticker string, bin int").parquet(plan_path)
    sources = _paths(plan)
    if not sources:
        return 0
    run = uuid.uuid4().hex
    lines = spark.read.text(sources).select(F.col("_metadata.file_path").alias("source"), "value")
    placed = lines.join(plan.select("source", "ticker", "bin"), "source")
    value = with_copy(F.col("value"), copy_from_path(F.col("source")))
    placed.select("ticker", "bin", value.alias("value")).repartition("ticker", "bin").write.partitionBy("ticker", "bin").text(f"{store}/lines/{run}")
    rows = plan.withColumn("run", F.lit(run))
    write_version(rows if manifest is None else manifest.unionByName(rows), f"{store}/manifest", note=run)
    return len(sources)


def compacted_paths(spark: SparkSession, landing: str, store: str) -> list[str]:
    """What to read in place of ``landing``: the packed runs, and the files that no finished run has packed."""
    manifest = read_version(spark, f"{store}/manifest")
    if manifest is None:
        return [landing]
    runs = [f"{store}/lines/{r['run']}" for r in manifest.select("run").distinct().collect()]
    loose = landed_files(spark, landing).join(manifest.select("source"), "source", "left_anti")
    return sorted(runs) + _paths(loose)


def read_compacted(spark: SparkSession, landing: str, store: str) -> DataFrame:
    """The bars of a landing, packed or not, as ``read_bars_json`` gives them (``source`` is the file they lie in now)."""
    return read_bars_json(spark, compacted_paths(spark, landing, store))
