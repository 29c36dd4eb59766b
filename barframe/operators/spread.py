"""Dealing the input of a generator over the cluster.

Adaptive execution sizes partitions by what they hold, and cannot know that a generator (copies,
unpacked sequences) follows and makes many times as much of it. So the rows before the generator
are dealt out to a number of partitions that it leaves alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, *columns: str, partitions: int | None = None) -> DataFrame:
    """``df`` dealt out by ``columns`` over ``partitions``, by default as many as the session shuffles to,
    and one for each core at least."""
    session = df.sparkSession
    n = partitions or max(int(session.conf.get("spark.sql.shuffle.partitions")), session.sparkContext.defaultParallelism)
    return df.repartition(int(n), *columns)
