"""Set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_by_name(frames: list[DataFrame], *, allow_missing: bool = True) -> DataFrame:
    """N-way bag union matched by column name (U1); a positional union would swap columns silently.

    Spark flattens the nested unions into one ``Union`` node, so this is a single stage.
    """
    if not frames:
        raise ValueError("need at least one frame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)
