"""Whole jobs composed from the operators.

Each job is one lineage with no per-ticker loop. Intermediate tables are written as Parquet and
read back — the written table is both the job's product and its lineage cut, so an executor
lost during the aggregates only recomputes from that table, not from the raw landing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from barframe.operators.aggregate import describe_before_after, yearly_summary
from barframe.operators.clean import coverage_report, filter_outliers
from barframe.operators.enrich import enrich
from barframe.operators.modeling import HORIZON, any_model_frame, ar1_predictions, evaluate, recursive_forecast
from barframe.operators.multiply import DEFAULT_COPIES, multiply_bars
from barframe.sources.readers import file_report, read_bars_json, read_bars_parquet
from barframe.plans.workspace import cut_lineage
from barframe.sources.writers import write_line_json, write_parquet


@dataclass
class SmallResult:
    profile: DataFrame  # before/after statistics
    clean: DataFrame  # enriched clean bars, read back from Parquet
    yearly: DataFrame  # (year, ticker, avg_close, avg_volatility)


def land_as_parquet(spark: SparkSession, landing: str, out: str, *, multiline: bool) -> DataFrame:
    """Parse the JSON landing once into a Parquet table and return a scan of it.

    JSON parsing is the expensive part of the scan; every later step (profile, cleaning, coverage)
    then reads Parquet with column pruning and pushed filters instead of re-parsing text.
    """
    return _written(spark, read_bars_json(spark, landing, multiline=multiline), out)


def _written(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """A product of a job as a Parquet table, read back."""
    write_parquet(df, path)
    return read_bars_parquet(spark, path, df.schema)


def landing_to_yearly(
    spark: SparkSession, landing: str, out_dir: str, *, multiline: bool = True, profile: str = "strict", exact: bool = False
) -> SmallResult:
    """Small job: JSON landing → Parquet → profile → clean → enrich → Parquet (by year) → yearly means.

    The landing is parsed once; the profile (one conditional aggregate) and the clean table read
    the Parquet copy; both yearly means come from one ``groupBy`` over the written clean table.
    """
    raw = land_as_parquet(spark, landing, f"{out_dir}/raw", multiline=multiline)
    prof = describe_before_after(raw, profile, exact=exact)
    clean = enrich(filter_outliers(raw, profile), returns=True)
    clean_path = f"{out_dir}/clean"
    write_parquet(clean, clean_path, partition_by=["year"])
    clean_back = read_bars_parquet(spark, clean_path, clean.schema)
    yearly = _written(spark, yearly_summary(clean_back, exact=exact), f"{out_dir}/yearly")
    return SmallResult(prof, clean_back, yearly)


def land_copies(bars: DataFrame, out: str, *, copies: int = DEFAULT_COPIES, seed: int = 42) -> None:
    """Multiply bars and land every copy as line JSON in ``ticker=…`` folders — one write."""
    write_line_json(multiply_bars(bars, copies, seed), out)


@dataclass
class LargeResult:
    coverage: DataFrame
    clean: DataFrame
    yearly: DataFrame
    files: DataFrame  # one row per landed file with its faulty records


def copies_to_yearly(
    spark: SparkSession,
    landing: str,
    out_dir: str,
    expected: DataFrame,
    *,
    profile: str = "close_volume",
    exact: bool | tuple[str, ...] = False,
) -> LargeResult:
    """Large job: all landed copies in one scan → Parquet → clean → enrich → Parquet → yearly means + coverage of the ``expected`` tickers."""
    raw = land_as_parquet(spark, landing, f"{out_dir}/raw", multiline=False)
    clean = enrich(filter_outliers(raw, profile), returns=False)
    clean_path = f"{out_dir}/clean"
    write_parquet(clean, clean_path, partition_by=["year"])
    clean_back = read_bars_parquet(spark, clean_path, clean.schema)
    yearly = _written(spark, yearly_summary(clean_back, keys=("year", "ticker"), exact=exact), f"{out_dir}/yearly")
    return LargeResult(coverage_report(expected, raw, profile), clean_back, yearly, file_report(spark, landing))


@dataclass
class ForecastResult:
    frame: DataFrame
    predictions: DataFrame
    metrics: DataFrame
    forecast: DataFrame


def forecast_all(
    bars: DataFrame,
    target: str = "close",
    horizon: int = HORIZON,
    *,
    fit_on: str = "all",
    business_days: bool = False,
    checkpoint: bool = True,
    block: str | None = None,
) -> ForecastResult:
    """Prediction job for every series: model frame, test predictions, metrics, recursive forecast.

    The three products all derive from the modelling frame; with ``checkpoint`` the frame is
    materialized once in the shared checkpoint folder, so the window chain runs once instead of
    once per product, and a lost executor re-reads the checkpoint. ``block`` cuts long series into
    calendar blocks (``'year'`` or ``'month'``), so that no task holds a whole one.
    """
    frame = any_model_frame(bars, target, fit_on=fit_on, block=block)
    if checkpoint:
        frame = cut_lineage(frame)
    preds = ar1_predictions(frame, target)
    return ForecastResult(frame, preds, evaluate(preds), recursive_forecast(frame, target, horizon=horizon, business_days=business_days))
