"""Tables of versions (K1): an overwrite that readers of the old state survive.

A version's rows go to a folder of their own; then one row in a commit folder names it. Until that row is
there the version does not exist, so a write that fails half-way leaves the old table as it was, and a reader
that has begun keeps the files it has listed. A table has one writer at a time; of two at once the later
commit counts and the other writer is told by an error.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barframe.sources.writers import write_parquet

COMMITS = "version bigint, folder string, columns string, note string"


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    schema: T.StructType
    note: str | None


def commits(spark: SparkSession, path: str) -> DataFrame:
    """``version, folder, columns, note`` of every finished version; no rows for a table that was never written."""
    try:
        return spark.read.schema(COMMITS).option("recursiveFileLookup", True).parquet(f"{path}/commits")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.range(0).select(*[F.lit(None).cast(f.split()[1]).alias(f.split()[0]) for f in COMMITS.split(", ")])


def find_version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The last finished version, or that of the given number; None if there is none."""
    found = commits(spark, path)
    if number is not None:
        found = found.where(F.col("version") == number)
    row = found.orderBy(F.desc("version")).first()
    return row and Version(row["version"], row["folder"], T.StructType.fromJson(json.loads(row["columns"])), row["note"])


def has_note(spark: SparkSession, path: str, note: str) -> bool:
    """Whether a finished version carries this note."""
    return not commits(spark, path).where(F.col("note") == note).isEmpty()


def write_version(df: DataFrame, path: str, *, partition_by: Sequence[str] | None = None, note: str | None = None) -> int:
    """Write ``df`` as the next version of the table at ``path`` and return its number.

    ``note`` goes into the commit (a batch's name, say). Nothing is deleted: older versions stay readable.
    """
    spark = df.sparkSession
    last = find_version(spark, path)
    number = last.number + 1 if last else 1
    folder = f"data/{uuid.uuid4().hex}"
    write_parquet(df, f"{path}/{folder}", mode="errorifexists", partition_by=partition_by)
    values = {"version": number, "folder": folder, "columns": df.schema.json(), "note": note}
    kinds = dict(f.split() for f in COMMITS.split(", "))
    row = spark.range(1).select(*[F.lit(v).cast(kinds[c]).alias(c) for c, v in values.items()])
    # The commit of a writer that stopped here is written again by the next one.
    row.coalesce(1).write.mode("overwrite").parquet(f"{path}/commits/{number:012d}")
    if find_version(spark, path, number).folder != folder:
        raise RuntimeError(f"another writer committed version {number} of {path}")
    return number


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame | None:
    """The rows of the last finished version (or of the given one), None if there is none."""
    found = find_version(spark, path, number)
    return found and spark.read.schema(found.schema).parquet(f"{path}/{found.folder}")
