"""Yearly means kept up to date from new landings alone.

The table holds a mergeable state for each (year, ticker): exact decimal sums and counts of close and rounded
volatility, and the double sum of the unrounded one. A batch is reduced to such states and added to the last
version, which is written as a new version with the batch's name in its commit. So a batch that runs again
after a failure counts once, and the cost of an update follows the batch and the number of keys, never the
bars taken in before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barframe.functions.expressions import intra_day_volatility
from barframe.sources.versions import has_note, read_version, write_version

_SUMS = {"sum_close": "decimal(38,4)", "sum_volatility": "decimal(38,4)", "sum_raw": "double"}
_COUNTS = ("n_close", "n_volatility", "n_raw")
KEYS = ("year", "ticker")


def yearly_state(enriched: DataFrame) -> DataFrame:
    """Partial sums and counts of enriched bars by (year, ticker); NULL, NaN and infinite values count as missing."""
    values = {"close": F.col("close"), "volatility": F.col("intra_day_volatility"), "raw": intra_day_volatility(digits=None)}
    aggs = []
    for name, c in values.items():
        finite = F.when(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), c)
        summed = finite if name == "raw" else finite.cast("decimal(18,4)")
        aggs += [F.sum(summed).cast(_SUMS[f"sum_{name}"]).alias(f"sum_{name}"), F.count(finite).alias(f"n_{name}")]
    return enriched.groupBy(*KEYS).agg(*aggs)


def merge_states(*states: DataFrame) -> DataFrame:
    """States of disjoint rows as one state."""
    rows = states[0]
    for other in states[1:]:
        rows = rows.unionByName(other)
    sums = [F.sum(c).cast(kind).alias(c) for c, kind in _SUMS.items()]
    return rows.groupBy(*KEYS).agg(*sums, *[F.sum(c).alias(c) for c in _COUNTS])


def absorb(enriched: DataFrame, store: str, batch: str) -> bool:
    """Add a batch of enriched bars to the state at ``store``; False, and nothing done, if it was added before.

    A batch's name must stand for the same rows whenever it is used. An empty batch makes a version as well.
    """
    spark = enriched.sparkSession
    if has_note(spark, store, batch):
        return False
    state, new = read_version(spark, store), yearly_state(enriched)
    write_version(new if state is None else merge_states(state, new), store, note=batch)
    return True


def yearly_means(spark: SparkSession, store: str, number: int | None = None) -> DataFrame | None:
    """``year, ticker, avg_close, avg_volatility, avg_raw_volatility`` of the last state (or of an earlier version)."""
    state = read_version(spark, store, number)
    if state is None:
        return None
    mean = lambda c: F.try_divide(F.col(f"sum_{c}").cast("double"), F.col(f"n_{c}"))
    return state.select(*KEYS, mean("close").alias("avg_close"), mean("volatility").alias("avg_volatility"), mean("raw").alias("avg_raw_volatility"))
