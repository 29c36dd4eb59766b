"""Models that outlive a run (M1, M2, M8): bounds and coefficients as versions of a table, new bars scored without a refit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barframe.operators.aggregate import series_keys
from barframe.operators.modeling import inverse_scale
from barframe.sources.versions import find_version, read_version, write_version


def series_models(frame: DataFrame, target: str = "close", *, fit_split: Sequence[str] = ("train",)) -> DataFrame:
    """A row for each series of a modelling frame, all that scoring a later bar needs.

    ``keys, slope, intercept, n_fit, lo, hi, last_date, last_value``: the AR(1) model on the scaled target, the bounds of the
    scaling, and the last bar seen. One aggregation; a series that could not be fitted has NULL coefficients.
    """
    on = F.col("split").isin(*fit_split)
    y, x = F.when(on, F.col("label")), F.when(on, F.col("prev_target"))
    return frame.groupBy(*series_keys(frame)).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_count(y, x).alias("n_fit"),
        F.max(f"min_{target}").alias("lo"), F.max(f"max_{target}").alias("hi"),
        F.max("date").alias("last_date"), F.max_by(target, "date").alias("last_value"),
    )


def store_models(frame: DataFrame, path: str, target: str = "close", *, fit_split: Sequence[str] = ("train",)) -> int:
    """Write the models of a frame as the next version of the table at ``path``; returns its number."""
    return write_version(series_models(frame, target, fit_split=fit_split), path, note=target)


def score_bars(spark: SparkSession, bars: DataFrame, path: str, target: str = "close", *, number: int | None = None) -> DataFrame:
    """Next-day predictions of later bars by the last stored models, or by those of version ``number``.

    ``keys, date, actual, predicted, last_value, status``: each bar is predicted from the one before it, a series' first from
    the last one that its model saw. Only ``bars`` and one row a series are read. Bars up to the model's last
    date, or without a date, are left out. ``status`` is ``ok``, ``no model`` (the series is new), ``no fit`` (its model has no
    coefficients) or ``no value before`` (the bar before has none); ``predicted`` is NULL unless ``ok``.
    """
    version = find_version(spark, path, number)
    if version is None:
        raise ValueError(f"no stored models at {path}" + (f" with number {number}" if number is not None else ""))
    if version.note != target:
        raise ValueError(f"the models at {path} predict {version.note!r}, not {target!r}")
    models, keys = read_version(spark, path, version.number), series_keys(bars)
    if series_keys(models) != keys:
        raise ValueError(f"models by {series_keys(models)}, bars by {keys}")
    new = bars.where(F.col("date").isNotNull()).select(*keys, "date", F.col(target).alias("actual"))
    same = [F.col(f"b.{k}").eqNullSafe(F.col(f"m.{k}")) for k in keys]
    held = models.withColumn("known", F.lit(True))
    later = F.col("last_date").isNull() | (F.col("date") > F.col("last_date"))
    rows = new.alias("b").join(held.alias("m"), same, "left").where(later).select("b.*", *[f"m.{c}" for c in held.columns if c not in keys])
    order = Window.partitionBy(*keys).orderBy("date")
    before = F.when(F.row_number().over(order) == 1, F.col("last_value")).otherwise(F.lag("actual").over(order))
    rows = rows.withColumn("before", before)
    scaled = F.when(F.col("hi") > F.col("lo"), (F.col("before") - F.col("lo")) / (F.col("hi") - F.col("lo"))).otherwise(F.when(F.col("before").isNotNull(), F.lit(0.0)))
    status = (
        F.when(F.col("known").isNull(), "no model").when(F.col("slope").isNull(), "no fit").when(F.col("before").isNull(), "no value before").otherwise("ok")
    )
    predicted = inverse_scale(F.col("intercept") + F.col("slope") * scaled, "lo", "hi")
    return rows.select(*keys, "date", "actual", F.when(status == "ok", predicted).alias("predicted"), F.col("before").alias("last_value"), status.alias("status"))
