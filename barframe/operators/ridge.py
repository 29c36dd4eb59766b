"""A regression of every series on all features (M3b, W15): one model per ticker, fitted by Spark.

For each series and part of the split one grouped aggregation gives the Gram matrix: the sums of
all products of the intercept, the inputs and the label. It is algebraic, so a series of any share
of the rows is added up map-side, and what is left is one small matrix per series. The ridge
equations are solved on batches of these matrices by elimination inside the tasks, for each penalty of a grid; the
penalty with the least squared error on the validation part is kept, that error being a quadratic
form of the validation part's matrix. No row is read twice, and no model is fitted on the driver. As the solver is a
step of its own, a filter on its results does not repeat it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barframe.operators.blocked import null_safe_join
from barframe.operators.modeling import HORIZON, SCALED_FEATURES, _keys, future_dates, inverse_scale

# The executors need not have this package: what the tasks run is sent to them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Penalties of the grid, each per training row (the intercept has none).
PENALTIES = (0.001, 0.01, 0.1)
INPUTS = [f"prev_{c}" for c in SCALED_FEATURES]


def gram_matrices(frame: DataFrame, inputs: Sequence[str], label: str = "label", *, keys=None) -> DataFrame:
    """``keys, train, n_train, validation, n_validation, constant``: the products' sums by series.

    A matrix has a row and a column for the intercept, each input and the label, in this order;
    ``constant`` counts the inputs with one value only in the training part. Rows with a NULL among
    the inputs or the label are left out. A part without rows has a NULL matrix.
    """
    ks = _keys(frame, keys)
    names = ["_one", *inputs, label]
    values = [F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate([*inputs, label])]
    rows = frame.na.drop(subset=[*inputs, label]).select(*ks, "split", *values)
    doubles = T.ArrayType(T.DoubleType())
    schema = T.StructType([*rows.schema[: len(ks) + 1], T.StructField("_n", T.LongType()), *[T.StructField(c, doubles) for c in ("_low", "_high", "_sum")]])
    summed = rows.mapInArrow(_product_sums(len(ks) + 1), schema)
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    sums = [F.sum(F.get("_sum", F.lit(k))).alias(f"_s{i}_{j}") for k, (i, j) in enumerate(pairs)]
    spans = [F.max(F.get("_high", F.lit(i))) == F.min(F.get("_low", F.lit(i))) for i in range(len(inputs))]
    constant = sum((s.cast("int") for s in spans), F.lit(0))
    by_part = summed.groupBy(*ks, "split").agg(F.sum("_n").alias("_n"), constant.alias("_constant"), *sums)
    cell = lambda i, j: F.col(f"_s{min(i, j)}_{max(i, j)}")
    matrix = F.array(*[F.array(*[cell(i, j) for j in range(len(names))]) for i in range(len(names))])
    of = lambda part, c: F.first(F.when(F.col("split") == part, c), ignorenulls=True)
    return by_part.select(*ks, "split", "_n", "_constant", matrix.alias("_m")).groupBy(*ks).agg(
        of("train", F.col("_m")).alias("train"), F.coalesce(of("train", F.col("_n")), F.lit(0)).alias("n_train"),
        of("validation", F.col("_m")).alias("validation"), F.coalesce(of("validation", F.col("_n")), F.lit(0)).alias("n_validation"),
        F.coalesce(of("train", F.col("_constant")), F.lit(0)).alias("constant"),
    )


def _product_sums(n_keys: int):
    """Batches of rows (``n_keys`` keys, then numbers) to a row for each key in a batch: count, least and greatest inputs, sums of all products.

    So many sums are more than Spark compiles into one aggregate; added up here, few rows reach it.
    """

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            if not batch.num_rows:
                continue
            keys = [batch.column(i) for i in range(n_keys)]
            codes = np.zeros(batch.num_rows, np.int64)
            for key in keys:
                own = pc.fill_null(pc.dictionary_encode(key).indices, -1).to_numpy().astype(np.int64)
                codes = np.unique(codes * (batch.num_rows + 1) + own + 1, return_inverse=True)[1].ravel()
            order = np.argsort(codes, kind="stable")
            starts = np.flatnonzero(np.diff(codes[order], prepend=-1))
            columns = [batch.column(i).to_numpy()[order] for i in range(n_keys, batch.num_columns)]
            x = np.column_stack([np.ones(len(order)), *columns])
            one, other = np.triu_indices(x.shape[1])
            listed = lambda m: pa.FixedSizeListArray.from_arrays(pa.array(m.ravel()), m.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [
                    *[key.take(pa.array(order[starts])) for key in keys], pa.array(np.diff(starts, append=len(order))),
                    listed(np.minimum.reduceat(x[:, 1:-1], starts)), listed(np.maximum.reduceat(x[:, 1:-1], starts)),
                    listed(np.add.reduceat(x[:, one] * x[:, other], starts)),
                ],
                names=[*batch.schema.names[:n_keys], "_n", "_low", "_high", "_sum"],
            )

    return batches


def ridge_solution(matrices: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    """The ridge coefficients (intercept first), a row for each of the Gram ``matrices``: Gauss-Jordan elimination in its own order.

    ``penalty`` has the penalty of each matrix. As it is positive, the equations are positive definite, so no pivot is zero.
    """
    unknowns = matrices.shape[1] - 1
    rows = matrices[:, :unknowns].copy()
    for i in range(1, unknowns):
        rows[:, i, i] += penalty
    for k in range(unknowns):
        pivot = rows[:, k].copy()
        rows = rows - (rows[:, :, k] / pivot[:, k, None])[:, :, None] * pivot[:, None, :]
        rows[:, k] = pivot / pivot[:, k, None]
    return rows[:, :, unknowns]


def squared_error(matrices: np.ndarray, coefficients: np.ndarray) -> np.ndarray:
    """The sums of squared residuals of ``coefficients`` on the rows behind each Gram matrix, at least 0."""
    weights = np.column_stack([coefficients, np.full(len(coefficients), -1.0)])
    products = sum(matrices[:, :, j] * weights[:, j, None] for j in range(weights.shape[1]))
    return np.maximum(sum(products[:, j] * weights[:, j] for j in range(weights.shape[1])), 0.0)


def _matrices(column: pa.Array, size: int) -> np.ndarray:
    """A column of matrices as one array; those that are NULL hold NaN."""
    out = np.full((len(column), size, size), np.nan)
    out[column.is_valid().to_numpy(zero_copy_only=False)] = column.flatten().flatten().to_numpy().reshape(-1, size, size)
    return out


def _solver(ks: Sequence[str], unknowns: int, penalties: Sequence[float]):
    """Batches of Gram matrices to batches with the penalty of the least validation error and its coefficients."""
    grid = np.array(sorted(penalties), float)

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            table = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            train, validation = (_matrices(table[c], unknowns + 1) for c in ("train", "validation"))
            n, n_validation = (table[c].to_numpy() for c in ("n_train", "n_validation"))
            with np.errstate(all="ignore"):
                tried = np.stack([ridge_solution(train, p * n) for p in grid])
                errors = np.stack([squared_error(validation, b) / n_validation for b in tried])
            checked, fitted = n_validation > 0, n > 0
            best = np.where(checked, np.argmin(np.where(np.isnan(errors), np.inf, errors), axis=0), len(grid) - 1)
            at = np.arange(len(best))
            values = pa.array(tried[best, at][fitted].ravel())
            ends = np.concatenate([[0], np.cumsum(fitted) * unknowns]).astype(np.int32)
            found_b = pa.ListArray.from_arrays(pa.array(ends), values, mask=pa.array(~fitted))
            yield pa.RecordBatch.from_arrays(
                [
                    *[table[c] for c in (*ks, "n_train", "n_validation", "constant")], pa.array(grid[best], mask=~fitted),
                    pa.array(errors[best, at], mask=~(fitted & checked)), found_b,
                ],
                names=[*ks, "n_train", "n_validation", "constant", "penalty", "validation_mse", "coefficients"],
            )

    return batches


def fit_series_regression(
    frame: DataFrame, inputs: Sequence[str] = INPUTS, label: str = "label", *, keys=None, penalties: Sequence[float] = PENALTIES
) -> DataFrame:
    """One ridge regression for each series of ``frame`` (made with ``previous=SCALED_FEATURES``).

    ``keys, status, n_train, n_validation, penalty, validation_mse, coefficients`` (intercept first).
    The fit is on the training part, the choice among ``penalties`` on the validation part (equal
    errors: the smaller). Status: ``ok``; ``singular`` (without a penalty there is no one solution: fewer
    training rows than unknowns, or an input that never changes), still fitted; ``no validation`` (no rows to
    choose by: the largest penalty); ``no fit`` (no training row), with NULL coefficients.
    """
    if missing := [c for c in [*inputs, label] if c not in frame.columns]:
        raise ValueError(f"the frame lacks {missing}: make it with previous=SCALED_FEATURES")
    if not penalties or min(penalties) <= 0:
        raise ValueError("penalties must be positive")
    ks = _keys(frame, keys)
    unknowns = len(inputs) + 1
    grams = gram_matrices(frame, inputs, label, keys=keys)
    fields = [f for f in grams.schema if f.name not in ("train", "validation")]
    schema = T.StructType(
        [*fields, T.StructField("penalty", T.DoubleType()), T.StructField("validation_mse", T.DoubleType()), T.StructField("coefficients", T.ArrayType(T.DoubleType()))]
    )
    solved = grams.mapInArrow(_solver(ks, unknowns, penalties), schema)
    status = (
        F.when(F.col("n_train") == 0, "no fit").when(F.col("n_validation") == 0, "no validation")
        .when((F.col("n_train") < unknowns) | (F.col("constant") > 0), "singular").otherwise("ok")
    )
    return solved.select(*ks, status.alias("status"), "n_train", "n_validation", "penalty", "validation_mse", "coefficients")


def _predicted(columns: Sequence[str]) -> Column:
    out = F.get("coefficients", F.lit(0))
    for i, c in enumerate(columns, 1):
        out = out + F.get("coefficients", F.lit(i)) * F.col(c)
    return out


def series_predictions(frame: DataFrame, fits: DataFrame, target: str = "close", inputs: Sequence[str] = INPUTS, *, keys=None) -> DataFrame:
    """Actual and predicted target of the test rows in original units, and the last value before (M4, M5).

    ``fits`` has a row a series; series without coefficients are left out. The columns are those of
    ``ar1_predictions``, so ``evaluate`` compares the two.
    """
    ks = _keys(frame, keys)
    rows = frame.where(F.col("split") == "test").na.drop(subset=list(inputs))
    scored = null_safe_join(rows, fits.where(F.col("coefficients").isNotNull()).select(*ks, "coefficients"), ks)
    lo, hi = F.col(f"min_{target}"), F.col(f"max_{target}")
    return scored.select(
        *ks, "date", inverse_scale("label", lo, hi).alias("actual"), inverse_scale(_predicted(inputs), lo, hi).alias("predicted"),
        inverse_scale("prev_target", lo, hi).alias("last_value"),
    )


def series_forecast(
    frame: DataFrame, fits: DataFrame, target: str = "close", *, horizon: int = HORIZON, keys=None, business_days: bool = False
) -> DataFrame:
    """Recursive forecast by each series' own regression (M6, M7): ``keys, step, date, predicted_<target>``.

    Every feature of the last known row makes the first step; in later steps the target is the
    prediction and the other features are scaled 0. Series without coefficients have no rows.
    """
    ks = _keys(frame, keys)
    last = frame.groupBy(*ks).agg(
        F.max_by(F.struct(*SCALED_FEATURES), "date").alias("last"), F.max("date").alias("last_date"),
        F.first(f"min_{target}").alias("lo"), F.first(f"max_{target}").alias("hi"),
    )
    known = null_safe_join(last, fits.where(F.col("coefficients").isNotNull()).select(*ks, "coefficients"), ks)
    first = _predicted([f"last.{c}" for c in SCALED_FEATURES])
    base, own = F.get("coefficients", F.lit(0)), F.get("coefficients", F.lit(SCALED_FEATURES.index(f"{target}_scaled") + 1))
    path = F.aggregate(
        F.sequence(F.lit(2), F.lit(max(horizon, 2))), F.array(first), lambda acc, _i: F.concat(acc, F.array(base + own * F.element_at(acc, -1)))
    )
    zipped = F.arrays_zip(F.slice(path, 1, horizon).alias("v"), future_dates(F.col("last_date"), horizon, business_days).alias("d"))
    return known.select(*ks, "lo", "hi", F.posexplode(zipped).alias("pos", "z")).select(
        *ks, (F.col("pos") + 1).alias("step"), F.col("z.d").alias("date"), inverse_scale(F.col("z.v"), "lo", "hi").alias(f"predicted_{target}")
    )
