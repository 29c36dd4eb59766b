"""The shared work folder for intermediate tables and round trips.

On a cluster the folder must be shared storage, so it is read from the session's
``spark.checkpoint.dir`` (the setting the cluster provides), else from the checkpoint folder set on
the context, else it lies in the warehouse folder, which is shared as well. No setting leads to a
temporary folder of one machine.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _conf(spark: SparkSession, key: str) -> str | None:
    try:
        v = spark.conf.get(key, None)
    except Exception:  # pragma: no cover - Connect sessions may refuse unknown keys
        v = None
    if not v:
        try:
            v = spark.sparkContext.getConf().get(key, None)
        except Exception:  # pragma: no cover
            v = None
    return v or None


def work_dir(spark: SparkSession) -> str:
    """Base folder for this library's intermediate data (shared storage on a cluster)."""
    base = _conf(spark, "spark.checkpoint.dir")
    if not base:
        try:
            base = spark.sparkContext.getCheckpointDir()
        except Exception:  # pragma: no cover
            base = None
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the work folder."""
    return f"{work_dir(spark)}/barframe/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, *, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    work_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
