"""The files below a folder as they are listed, not as a scan sees them.

Spark's scans skip files of zero bytes, so a landing that was cut off at once leaves no trace in them. Here
tasks list the folders themselves: one Spark job for each level of folders, its folders dealt over the cluster. The lists
stay in tables of the shared work folder; nothing but the number of folders of a level comes to the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barframe.functions.expressions import ticker_from_path
from barframe.plans.workspace import scratch_path

_ENTRIES = "source string, path string, n_bytes bigint, modified timestamp, is_folder boolean"
#: Folders listed by one task.
FOLDERS_PER_TASK = 64
#: ASCII characters that stay as they are in Spark's encoded paths; letters beyond ASCII stay as well.
PLAIN = "/!$&'()*+,;=:@~-._"


def qualified(path: str) -> str:
    """``path`` as Spark names it in ``source``: with a scheme (``file:/…`` for local paths), without a slash at its end."""
    local = path.removeprefix("file:")
    return (path if "://" in local else "file:/" + local.lstrip("/")).rstrip("/")


def _lister(root: str):
    """The entries of each folder of a batch, by paths relative to ``root``; a folder that is not there has none."""

    def entries(folders: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = fs.FileSystem.from_uri(root.removeprefix("file:"))
        for batch in folders:
            for folder in batch.column(0).to_pylist():
                listed = files.get_file_info(fs.FileSelector(f"{base}/{folder}".rstrip("/"), allow_not_found=True))
                found = [f for f in listed if not f.base_name.startswith(("_", "."))]
                paths = [f"{folder}/{f.base_name}".lstrip("/") for f in found]
                folders_ = [f.type == fs.FileType.Directory for f in found]
                columns = [
                    pa.array([f"{root}/" + re.sub("[\x00-\x7f]+", lambda m: quote(m[0], safe=PLAIN), p) for p in paths], pa.string()), pa.array(paths, pa.string()),
                    pa.array([f.size or 0 for f in found], pa.int64()), pa.array([f.mtime for f in found], pa.timestamp("us", "UTC")),
                    pa.array(folders_, pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["source", "path", "n_bytes", "modified", "is_folder"])

    return entries


def file_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """``source, path, n_bytes, modified`` of every file below ``folder``, those of zero bytes included.

    ``source`` is URL-encoded, as ``_metadata.file_path`` is; ``path`` is relative to the folder. Names that begin with
    ``_`` or ``.`` are hidden, as in Spark's scans. ``folder`` is one folder, not a glob, of a file system that
    pyarrow reaches; one that does not exist has no files.
    """
    entries = _lister(qualified(folder))
    out = scratch_path(spark, "inventory")
    folders, n, level = spark.range(1).select(F.lit("").alias("path")), 1, 0
    while n:
        folders.repartition(-(-n // FOLDERS_PER_TASK)).mapInArrow(entries, _ENTRIES).write.parquet(f"{out}/level={level}")
        folders = spark.read.schema(_ENTRIES).parquet(f"{out}/level={level}").where("is_folder").select("path")
        n, level = folders.count(), level + 1
    found = spark.read.schema(_ENTRIES).parquet(*[f"{out}/level={i}" for i in range(level)])
    return found.where("NOT is_folder").drop("is_folder")


def inventory_report(report: DataFrame, inventory: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """A row for each listed file, and for each ``expected`` one (column ``path``, relative to the folder) that is not there.

    ``path, ticker, n_bytes, n_records, n_malformed, n_no_date, n_incomplete, status``: ``report`` is that of
    ``file_report`` over the same folder. Status: its own, ``empty`` for a file of zero bytes, ``missing`` for an expected
    file that was not listed. Without ``expected`` no file is missing.
    """
    counts = ["n_records", "n_malformed", "n_no_date", "n_incomplete"]
    rows = inventory.select("source", "path", "n_bytes").join(report.select("source", *counts, "status"), "source", "left")
    status = F.when(F.col("n_bytes") == 0, "empty").otherwise(F.coalesce("status", F.lit("empty")))
    listed = rows.select("path", ticker_from_path(F.concat(F.lit("/"), "path")).alias("ticker"), "n_bytes", *counts, status.alias("status"))
    if expected is not None:
        absent = expected.select("path").where(F.col("path").isNotNull()).distinct().join(listed.select("path"), "path", "left_anti")
        empty = [F.lit(None).cast("bigint").alias(c) for c in ("n_bytes", *counts)]
        listed = listed.unionByName(absent.select("path", ticker_from_path(F.concat(F.lit("/"), "path")).alias("ticker"), *empty, F.lit("missing").alias("status")))
    return listed.na.fill(0, ["n_bytes", *counts])
