"""Aggregations.

Every aggregate here is algebraic (count/sum/avg/min/max/stddev), so Spark plans a partial
aggregate on each input split and ships one row per key and split through the exchange —
a key holding a third of the rows costs no more shuffle than any other key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barframe.functions.expressions import intra_day_volatility
from barframe.operators.clean import OutlierProfile, outlier_predicate
from barframe.schema import VALUE_COLUMNS

STAT_NAMES = ("count", "mean", "stddev", "min", "max")


def mean(c, *, exact: bool = False, wide: bool = False) -> Column:
    """Mean of a column. ``exact=True`` sums the values as ``decimal(18,4)`` — exact and independent
    of partitioning or summation order — then divides once in double. Use it for values with at
    most 4 decimals (prices, 2-dp percentages, volumes): the result is then reproducible bit for
    bit across runs, cluster sizes and engines. The default is the plain double ``avg``.
    NaN and infinite values count as missing in the exact mean; ``wide`` sums ``decimal(28,4)`` for
    input that may hold values beyond 1e13.
    """
    c = F.col(c) if isinstance(c, str) else c
    if not exact:
        return F.avg(c)
    as_double = c.cast("double")
    finite = F.when(~F.isnan(as_double) & (F.abs(as_double) < F.lit(float("inf"))), c)
    return F.try_divide(F.sum(finite.cast("decimal(28,4)" if wide else "decimal(18,4)")).cast("double"), F.count(finite))


def yearly_summary(
    df: DataFrame,
    *,
    volatility: str = "rounded",
    keys: Sequence[str] = ("year", "ticker"),
    exact: bool | Sequence[str] = False,
) -> DataFrame:
    """Mean close and mean intraday volatility per (year, ticker) in one pass (A1 + A2/A3).

    ``volatility='rounded'`` averages the stored 2-dp ``intra_day_volatility`` (pipelines);
    ``'raw'`` averages the unrounded ``(high-low)/open*100`` (chart script).
    ``exact`` selects the decimal-sum mean (see ``mean``): ``True`` for both outputs, or the
    names of the outputs to compute exactly (e.g. ``("avg_volatility",)`` when the closes carry
    noise with unbounded decimals). It never applies to the raw volatility.
    """
    if "year" not in df.columns:
        df = df.withColumn("year", F.year("date"))
    if volatility == "rounded":
        vol = F.col("intra_day_volatility") if "intra_day_volatility" in df.columns else intra_day_volatility()
    elif volatility == "raw":
        vol = intra_day_volatility(digits=None)
    else:
        raise ValueError("volatility must be 'rounded' or 'raw'")
    exact_set = {"avg_close", "avg_volatility"} if exact is True else set(exact or ())
    return df.groupBy(*keys).agg(
        mean("close", exact="avg_close" in exact_set).alias("avg_close"),
        mean(vol, exact="avg_volatility" in exact_set and volatility == "rounded").alias("avg_volatility"),
    )


def _stats(c: Column, exact: bool = False) -> list[Column]:
    return [F.count(c), mean(c, exact=exact, wide=True), F.stddev_samp(c), F.min(c), F.max(c)]


def _unpivot_stats(one_row: DataFrame, stages: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One wide row of ``<stage>__<column>__<stat>`` values -> typed long rows."""
    entries = []
    for stage in stages:
        for col in columns:
            fields = [F.col(f"`{stage}__{col}__{s}`").cast("double" if s != "count" else "bigint").alias(s) for s in STAT_NAMES]
            entries.append(F.struct(F.lit(stage).alias("stage"), F.lit(col).alias("field"), *fields))
    return one_row.select(F.explode(F.array(*entries)).alias("s")).select("s.*")


def describe_bars(df: DataFrame, columns: Sequence[str] = VALUE_COLUMNS, *, exact: bool = False) -> DataFrame:
    """Typed ``describe`` (A4): one row per column (``field``) with count, mean, sample stddev, min, max.

    Spark's ``describe`` returns strings; this returns numbers, from one aggregate pass.
    """
    aggs = []
    for col in columns:
        for s, e in zip(STAT_NAMES, _stats(F.col(col), exact)):
            aggs.append(e.alias(f"all__{col}__{s}"))
    return _unpivot_stats(df.agg(*aggs), ["all"], columns).drop("stage")


def describe_before_after(
    df: DataFrame, profile: str | OutlierProfile = "strict", columns: Sequence[str] = VALUE_COLUMNS, *, exact: bool = False
) -> DataFrame:
    """Profile before and after cleaning (A5) in one scan: the "after" statistics are
    conditional aggregates over the rows the profile keeps.
    """
    keep = F.coalesce(outlier_predicate(profile), F.lit(False))
    aggs = []
    for col in columns:
        for s, e in zip(STAT_NAMES, _stats(F.col(col), exact)):
            aggs.append(e.alias(f"before__{col}__{s}"))
        for s, e in zip(STAT_NAMES, _stats(F.when(keep, F.col(col)), exact)):
            aggs.append(e.alias(f"after__{col}__{s}"))
    return _unpivot_stats(df.agg(*aggs), ["before", "after"], columns)


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of one column in ascending order."""
    return df.select(column).distinct().orderBy(column)


def series_keys(df: DataFrame) -> list[str]:
    """Series identity: ``ticker`` plus ``copy_id`` when copies are present."""
    return ["ticker", "copy_id"] if "copy_id" in df.columns else ["ticker"]


def series_stats(df: DataFrame, columns: Sequence[str] = ("close",), keys: Sequence[str] | None = None) -> DataFrame:
    """Per series: row count, first/last date, and min/max of each column."""
    keys = list(keys) if keys is not None else series_keys(df)
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date")]
    for c in columns:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.groupBy(*keys).agg(*aggs)
