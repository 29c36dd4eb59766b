import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barframe.operators.modeling import SCALED_FEATURES, ar1_predictions, chronological_split, evaluate, model_frame
from barframe.operators.ridge import INPUTS, PENALTIES, fit_series_regression, gram_matrices, series_forecast, series_predictions
from tests.conftest import bars


def made(spark, parts, inputs=3, seed=1):
    """Rows of (ticker, date, split, x0.., label): ``parts`` maps a ticker to (train, validation, test) counts."""
    rng = random.Random(seed)
    rows = []
    for ticker, counts in parts.items():
        day = dt.date(2024, 1, 1)
        for split, n in zip(("train", "validation", "test"), counts):
            for _ in range(n):
                x = [rng.random() for _ in range(inputs)]
                if ticker == "flat":
                    x[1] = 0.25
                y = 0.3 + sum((i + 1) * v for i, v in enumerate(x)) / 10 + rng.gauss(0, 0.05)
                rows.append((ticker, day, split, *x, y))
                day += dt.timedelta(days=1)
    names = [f"x{i}" for i in range(inputs)]
    schema = ", ".join(["ticker string", "date date", "split string", *(f"{n} double" for n in names), "label double"])
    return spark.createDataFrame(rows, schema), rows, names


def solved(x, y, penalty):
    x = np.column_stack([np.ones(len(x)), x])
    ridge = penalty * len(x) * np.diag([0.0] + [1.0] * (x.shape[1] - 1))
    return np.linalg.solve(x.T @ x + ridge, x.T @ y)


def test_equals_the_normal_equations_of_each_series(spark):
    parts = {"a": (40, 10, 5), "b": (60, 6, 3), "flat": (30, 5, 2), "few": (3, 2, 1), None: (25, 4, 4), "unchecked": (20, 0, 2), "untrained": (0, 3, 1)}
    df, rows, names = made(spark, parts)
    got = {r["ticker"]: r for r in fit_series_regression(df, names, keys=["ticker"]).collect()}
    assert set(got) == set(parts)
    status = {"a": "ok", "b": "ok", None: "ok", "flat": "singular", "few": "singular", "unchecked": "no validation", "untrained": "no fit"}
    assert {k: r["status"] for k, r in got.items()} == status
    for ticker, (n, n_val, _) in parts.items():
        r = got[ticker]
        assert (r["n_train"], r["n_validation"]) == (n, n_val)
        if n == 0:
            assert r["coefficients"] is None and r["penalty"] is None and r["validation_mse"] is None
            continue
        of = lambda split: np.array([x[3:] for x in rows if x[0] == ticker and x[2] == split])
        train, val = of("train"), of("validation")
        tried = []
        for p in PENALTIES:
            b = solved(train[:, :-1], train[:, -1], p)
            mse = np.mean((val[:, -1] - b[0] - val[:, :-1] @ b[1:]) ** 2) if n_val else None
            tried.append((mse, p, b))
        mse, p, b = min(tried, key=lambda t: t[:2]) if n_val else tried[-1]
        assert r["penalty"] == p and np.allclose(r["coefficients"], b, atol=1e-9)
        assert (r["validation_mse"] is None) == (mse is None) and (mse is None or abs(r["validation_mse"] - mse) < 1e-9)


def test_rows_with_null_inputs_are_left_out(spark):
    df, _, names = made(spark, {"a": (30, 6, 0)})
    holed = df.unionByName(df.limit(5).withColumn("x1", F.lit(None).cast("double"))).unionByName(df.limit(3).withColumn("label", F.lit(None).cast("double")))
    one, two = (fit_series_regression(d, names, keys=["ticker"]).first() for d in (df, holed))
    assert np.allclose(one["coefficients"], two["coefficients"], atol=1e-12) and one["n_train"] == two["n_train"]


def test_arguments_and_empty_frame(spark):
    df, _, names = made(spark, {"a": (5, 2, 1)})
    with pytest.raises(ValueError, match="lacks"):
        fit_series_regression(df, ["y0"])
    with pytest.raises(ValueError, match="positive"):
        fit_series_regression(df, names, keys=["ticker"], penalties=[0.0])
    assert fit_series_regression(df.limit(0), names, keys=["ticker"]).count() == 0


def walk(n, seed):
    rng = random.Random(seed)
    close, out = 100.0, []
    for i in range(n):
        close = max(5.0, close + rng.gauss(0, 2) + (100 - close) * 0.2)
        day = dt.date(2020, 1, 1) + dt.timedelta(days=i)
        out.append((f"T{seed}", day.isoformat(), close - 1, close + 2, close - 3, close, 1000.0 + rng.randrange(500)))
    return out


def test_predictions_and_forecast_of_all_series(spark):
    short = walk(30, 9)
    frame = model_frame(bars(spark, walk(300, 1) + walk(400, 2) + short), "close", previous=SCALED_FEATURES).cache()
    fits = fit_series_regression(frame)
    scored = series_predictions(frame, fits)
    own, plain = ({r["ticker"]: r for r in evaluate(p).collect()} for p in (scored, ar1_predictions(frame)))
    for t in ("T1", "T2"):
        assert own[t]["n_test"] == plain[t]["n_test"] and own[t]["rmse"] < own[t]["rmse_last_value"]
    path = series_forecast(frame, fits, horizon=4, business_days=True).orderBy("ticker", "step").collect()
    assert [r["step"] for r in path if r["ticker"] == "T1"] == [1, 2, 3, 4] and all(r["date"].weekday() < 5 for r in path)
    last = frame.where("ticker = 'T1'").orderBy(F.desc("date")).first()
    b = fits.where("ticker = 'T1'").first()["coefficients"]
    at = b[0] + sum(w * last[c] for w, c in zip(b[1:], SCALED_FEATURES))
    want = []
    for _ in range(4):
        want.append(at * (last["max_close"] - last["min_close"]) + last["min_close"])
        at = b[0] + b[1 + SCALED_FEATURES.index("close_scaled")] * at
    assert np.allclose([r["predicted_close"] for r in path if r["ticker"] == "T1"], want)


def test_gram_matrix_adds_up_before_the_shuffle(spark):
    df, _, names = made(spark, {"a": (5, 2, 1)})
    plan = gram_matrices(df, names, keys=["ticker"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and len(INPUTS) == 12


def test_a_filter_on_the_fits_does_not_repeat_the_solver(spark):
    df, _, names = made(spark, {"a": (20, 5, 3)})
    fits = fit_series_regression(df, names, keys=["ticker"]).where(F.col("coefficients").isNotNull())
    plan = fits._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan and plan.count("MapInArrow") == 2  # the sums and the solver, once each


def test_rows_in_any_order_and_their_place_in_the_split(spark):
    df, _, names = made(spark, {"a": (40, 10, 5), None: (25, 4, 4)})
    one, two = ({r["ticker"]: r for r in fit_series_regression(d, names, keys=["ticker"]).collect()} for d in (df, df.orderBy("x0").coalesce(1)))
    assert all(one[t]["n_train"] == two[t]["n_train"] and np.allclose(one[t]["coefficients"], two[t]["coefficients"], atol=1e-12) for t in ("a", None))
    frame = model_frame(bars(spark, walk(90, 3) + walk(301, 4)), "close")
    again = chronological_split(frame.drop("split"))
    same = frame.select("ticker", "date", "split").exceptAll(again.select("ticker", "date", "split"))
    assert same.count() == 0 and "n_rows" not in frame.columns
