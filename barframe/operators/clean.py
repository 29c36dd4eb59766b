"""Filters and validation.

Predicates are plain column comparisons, so on a Parquet source they reach the scan as
``PushedFilters`` and row groups outside the bounds are skipped.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class OutlierProfile:
    """Which prices are bounded, the open price interval, the minimum volume, and whether a row
    also needs a date and a volume that is a number (NaN passes a plain ``>=``)."""

    price_columns: tuple[str, ...]
    lower: float = 0.0  # exclusive
    upper: float = 100000.0  # exclusive
    min_volume: float = 0.0  # inclusive
    complete: bool = False


# The two cleaning profiles and their bounds.
#   strict        open, high, low, close each in (0, 100000); volume >= 0
#   close_volume  close in (0, 100000); volume >= 0
# and the strict rule that also rejects rows without a readable date or with a NaN volume:
PROFILES = {
    "strict": OutlierProfile(("open", "high", "low", "close")),
    "close_volume": OutlierProfile(("close",)),
    "strict_complete": OutlierProfile(("open", "high", "low", "close"), complete=True),
}


def _profile(profile: str | OutlierProfile) -> OutlierProfile:
    return PROFILES[profile] if isinstance(profile, str) else profile


def outlier_predicate(profile: str | OutlierProfile = "strict") -> Column:
    """True for rows to keep. NULL in any checked column makes the predicate NULL (row dropped)."""
    p = _profile(profile)
    cond = None
    for c in p.price_columns:
        term = (F.col(c) > F.lit(p.lower)) & (F.col(c) < F.lit(p.upper))
        cond = term if cond is None else cond & term
    vol = F.col("volume") >= F.lit(p.min_volume)
    if p.complete:
        vol = vol & ~F.isnan("volume") & F.col("date").isNotNull()
    return vol if cond is None else cond & vol


def filter_outliers(df: DataFrame, profile: str | OutlierProfile = "strict") -> DataFrame:
    """Keep plausible bars (F1 ``strict``, F2 ``close_volume``)."""
    return df.filter(outlier_predicate(profile))


def reject_reasons(profile: str | OutlierProfile = "strict") -> Column:
    """Comma-separated reasons a row fails the profile (empty string when it passes)."""
    p = _profile(profile)
    parts = [F.when(F.col("date").isNull(), F.lit("date:null"))] if p.complete else []
    for c in p.price_columns:
        parts.append(
            F.when(F.col(c).isNull(), F.lit(f"{c}:null"))
            .when(~((F.col(c) > F.lit(p.lower)) & (F.col(c) < F.lit(p.upper))), F.lit(f"{c}:out_of_range"))
        )
    volume = F.when(F.col("volume").isNull(), F.lit("volume:null")).when(
        F.col("volume") < F.lit(p.min_volume), F.lit("volume:below_min")
    )
    parts.append(volume.when(F.isnan("volume"), F.lit("volume:nan")) if p.complete else volume)
    return F.concat_ws(",", *parts)


def rejected_rows(df: DataFrame, profile: str | OutlierProfile = "strict") -> DataFrame:
    """Complement of ``filter_outliers`` with a ``reasons`` column (F3); kept + rejected = input."""
    keep = F.coalesce(outlier_predicate(profile), F.lit(False))
    return df.filter(~keep).withColumn("reasons", reject_reasons(profile))


def restrict_dates(df: DataFrame, start: str | _dt.date | None = None, end: str | _dt.date | None = None) -> DataFrame:
    """History range (S9): ``start`` inclusive, ``end`` exclusive, either side optional."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        cond = cond & (F.col("date") < F.lit(end).cast("date"))
    return df.filter(cond)


def drop_incomplete(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows with any NULL or NaN (F9), optionally only looking at ``subset``."""
    return df.na.drop(how="any", subset=subset)


def select_series(df: DataFrame, ticker: str | None = None, year: int | None = None) -> DataFrame:
    """One ticker and/or one year (F8)."""
    cond = F.lit(True)
    if ticker is not None:
        cond = cond & (F.col("ticker") == F.lit(ticker))
    if year is not None:
        cond = cond & (F.col("year") == F.lit(year)) if "year" in df.columns else cond & (F.year("date") == F.lit(year))
    return df.filter(cond)


def missing_tickers(expected: DataFrame, bars: DataFrame) -> DataFrame:
    """Expected tickers with no bar at all (V1): a left anti join on ``ticker``.

    The bar side is reduced to its distinct tickers first (a partial aggregate), so the join sees
    one row per ticker — a ticker holding a third of the bars costs nothing extra.
    """
    return expected.select("ticker").distinct().join(bars.select("ticker").distinct(), "ticker", "left_anti")


def coverage_report(expected: DataFrame, bars: DataFrame, profile: str | OutlierProfile = "strict") -> DataFrame:
    """Per expected ticker: raw bars, bars kept by ``profile``, and a status.

    Status: ``ok``; ``no data`` (no bar at all — the missing-file / empty-download case);
    ``no clean data`` (bars exist but the profile rejects all of them).
    Both sides are aggregated to one row per ticker before the join, so the join input is the
    ticker count, not the bar count; adaptive execution picks broadcast or shuffle from the
    measured size.
    """
    keep = F.coalesce(outlier_predicate(profile), F.lit(False))
    counts = bars.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n_bars"),
        F.count(F.when(keep, F.lit(1))).alias("n_clean"),
    )
    exp = expected.select("ticker").distinct()
    joined = exp.join(counts, "ticker", "left")
    n_bars = F.coalesce(F.col("n_bars"), F.lit(0)).cast("bigint")
    n_clean = F.coalesce(F.col("n_clean"), F.lit(0)).cast("bigint")
    status = F.when(n_bars == 0, F.lit("no data")).when(n_clean == 0, F.lit("no clean data")).otherwise(F.lit("ok"))
    return joined.select("ticker", n_bars.alias("n_bars"), n_clean.alias("n_clean"), status.alias("status"))


__all__ = [
    "PROFILES",
    "OutlierProfile",
    "coverage_report",
    "drop_incomplete",
    "filter_outliers",
    "missing_tickers",
    "outlier_predicate",
    "reject_reasons",
    "rejected_rows",
    "restrict_dates",
    "select_series",
]
