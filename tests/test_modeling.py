import datetime as dt
import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from barframe.operators.modeling import (
    ar1_coefficients,
    ar1_predictions,
    chronological_split,
    evaluate,
    future_dates,
    inverse_scale,
    last_rows,
    make_sequences,
    min_max_scale,
    model_frame,
    recursive_forecast,
    sequence_length,
)
from tests.conftest import series


def test_sequence_length_rule(spark):
    df = spark.createDataFrame([(50,), (400,), (4,)], "n long")
    got = [r.L for r in df.select(sequence_length(F.col("n")).alias("L")).collect()]
    assert got == [10, 60, 0]


def test_split_sizes(spark):
    seqs = series(spark, [float(i) for i in range(101)])
    counts = {r.split: r["count"] for r in chronological_split(seqs).groupBy("split").count().collect()}
    assert counts == {"test": 21, "train": 72, "validation": 8}
    # chronological: every train date precedes every validation date, which precedes every test date
    labeled = chronological_split(seqs).groupBy("split").agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    b = {r.split: (r.lo, r.hi) for r in labeled.collect()}
    assert b["train"][1] < b["validation"][0] and b["validation"][1] < b["test"][0]


def test_constant_feature_scales_to_zero(spark):
    df = series(spark, [5.0, 5.0, 5.0])
    got = min_max_scale(df, ["close"]).select("close_scaled").collect()
    assert [r.close_scaled for r in got] == [0.0, 0.0, 0.0]
    df = series(spark, [1.0, 3.0, 2.0])
    got = [r.close_scaled for r in min_max_scale(df, ["close"]).orderBy("date").collect()]
    assert got == [0.0, 1.0, 0.5]
    back = min_max_scale(df, ["close"]).select(inverse_scale("close_scaled", "min_close", "max_close").alias("c"))
    assert sorted(r.c for r in back.collect()) == [1.0, 2.0, 3.0]


def test_sequences_window_contents(spark):
    closes = [float(i) for i in range(50)]  # L = 10
    seqs = make_sequences(series(spark, closes), ["close"], "close")
    rows = seqs.orderBy("date").collect()
    assert len(rows) == 40
    first = rows[0]
    assert first.seq_len == 10 and first.pos == 10 and first.label == 10.0 and first.prev_target == 9.0
    assert [s[0] for s in first.sequence] == [float(i) for i in range(10)]
    assert [s[0] for s in rows[-1].sequence] == [float(i) for i in range(39, 49)]


def test_last_rows(spark):
    df = series(spark, [float(i) for i in range(10)])
    assert sorted(r.close for r in last_rows(df, 3).collect()) == [7.0, 8.0, 9.0]


def test_future_dates(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 30),)], "d date")
    got = df.select(future_dates(F.col("d"), 3).alias("x")).first().x
    assert got == [dt.date(2024, 1, 31), dt.date(2024, 2, 1), dt.date(2024, 2, 2)]
    biz = df.select(future_dates(F.col("d"), 5, business_days=True).alias("x")).first().x
    assert all(d.weekday() < 5 for d in biz) and len(biz) == 5 and biz[0] == dt.date(2024, 1, 31)


def _ar_series(spark, n=400, a=0.3, b=0.9, start=10.0):
    xs = [start]
    for i in range(1, n):
        xs.append(a + b * xs[-1] + (0.5 if i % 3 == 0 else -0.25))
    return series(spark, [round(x, 6) for x in xs])


def test_ar1_fit_and_recursive_forecast_match_python(spark):
    frame = model_frame(_ar_series(spark), "close")
    co = ar1_coefficients(frame).first()
    assert co.n_fit > 0 and co.slope is not None
    fc = recursive_forecast(frame, "close", horizon=5).orderBy("step").collect()
    assert [r.step for r in fc] == [1, 2, 3, 4, 5]
    last = frame.orderBy(F.col("date").desc()).first()
    x, lo, hi = last.label, last.min_close, last.max_close
    exp = []
    for _ in range(5):
        x = co.intercept + co.slope * x
        exp.append(x * (hi - lo) + lo)
    assert [r.predicted_close for r in fc] == pytest.approx(exp, rel=1e-12)
    assert fc[0].date == last.date + dt.timedelta(days=1)


def test_predictions_and_metrics(spark):
    frame = model_frame(_ar_series(spark), "close")
    preds = ar1_predictions(frame)
    n_test = frame.filter(F.col("split") == "test").count()
    assert preds.count() == n_test
    m = evaluate(preds).first()
    assert m.n_test == n_test and m.rmse == pytest.approx(math.sqrt(m.mse)) and m.mae >= 0


def test_fit_on_train_bounds_use_only_early_rows(spark):
    frame = model_frame(_ar_series(spark), "close", fit_on="train")
    test_rows = frame.filter(F.col("split") == "test")
    # scaled values of test rows may leave [0, 1] because the scaler never saw them
    assert test_rows.count() > 0
    w = Window.partitionBy("ticker")
    assert frame.select(F.max("max_close").over(w)).first()[0] is not None


def test_blocked_model_frame_equals_model_frame(spark):
    from barframe.operators.blocked import model_frame_blocked

    df = _ar_series(spark, n=700).unionByName(
        series(spark, [float(10 + (i % 7)) for i in range(300)], ticker="U", start="2021-03-01")
    )
    whole = model_frame(df, "close", with_arrays=True)
    for block in ("year", "month"):
        blocked = model_frame_blocked(df, "close", block=block, with_arrays=True)
        assert blocked.columns == whole.columns
        assert sorted(map(tuple, blocked.collect())) == sorted(map(tuple, whole.collect()))


def test_forecast_job_products(spark):
    from barframe.plans.jobs import forecast_all

    res = forecast_all(_ar_series(spark), "close", horizon=7)
    assert res.forecast.count() == 7
    assert res.metrics.count() == 1
    assert res.predictions.count() == res.frame.filter(F.col("split") == "test").count()


def test_blocked_model_frame_fit_on_train(spark):
    from barframe.operators.blocked import model_frame_blocked

    df = _ar_series(spark, n=500)
    whole = model_frame(df, "close", fit_on="train")
    blocked = model_frame_blocked(df, "close", block="month", fit_on="train")
    assert blocked.columns == whole.columns
    assert sorted(map(tuple, blocked.collect())) == sorted(map(tuple, whole.collect()))


def test_forecast_status_lists_every_series(spark):
    from barframe.operators.modeling import forecast_status

    long = series(spark, [100.0 + (i * 7 % 11) for i in range(80)], ticker="LONG")
    both = long.unionByName(series(spark, [1.0, 2.0, 3.0], ticker="SHORT")).unionByName(series(spark, [5.0] * 60, ticker="FLAT"))
    got = {r.ticker: r.status for r in forecast_status(both, model_frame(both, "close")).collect()}
    assert got["LONG"] == "ok" and got["SHORT"] == "too short" and set(got) == {"LONG", "SHORT", "FLAT"}


def test_lags_use_the_history_before_the_sequences(spark):
    from barframe.operators.modeling import lag_features

    frame = model_frame(series(spark, [100.0 + (i * 7 % 11) for i in range(80)]), "close", n_lags=5)
    assert lag_features(frame).count() == frame.count() > 0


def test_blocked_windows_keep_rows_with_null_keys_and_dates(spark):
    from pyspark.sql import functions as F

    from barframe.operators.blocked import indicators_blocked
    from barframe.operators.indicators import indicators

    rows = series(spark, [100.0 + (i * 7 % 11) for i in range(400)])
    rows = rows.withColumn("ticker", F.lit(None).cast("string")).withColumn("date", F.when(F.col("date") > "2024-01-01", F.col("date")))
    assert indicators_blocked(rows).count() == indicators(rows).count() > 0


def test_exact_mean_of_dirty_values(spark):
    from barframe.operators.aggregate import describe_bars, mean

    frame = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (3.0,)], "close double")
    assert frame.agg(mean("close", exact=True)).first()[0] == 2.0
    far = spark.createDataFrame([(1e15,), (1.0,)], "close double")
    assert describe_bars(far, ["close"], exact=True).first()["mean"] == (1e15 + 1) / 2


def test_feature_forecast_follows_its_recursion(spark):
    """First step from every feature of the last row, then the target alone with the others at 0."""
    import math

    from barframe.operators.modeling import SCALED_FEATURES, feature_forecast, fit_feature_regression, model_frame
    from tests.conftest import bars as make_bars
    import datetime as dt

    rows = []
    for i in range(120):
        c = 50 + 10 * math.sin(i / 7) + (i * 37 % 11) / 3
        day = (dt.date(2024, 1, 1) + dt.timedelta(days=i)).isoformat()
        rows.append(("T", day, c + (i * 13 % 7) / 5, c + 3 + (i * 17 % 5) / 4, c - 3 - (i * 7 % 3) / 2, c, 100.0 + (i * 29 % 23)))
    frame = model_frame(make_bars(spark, rows), "close", previous=SCALED_FEATURES)
    model, scored = fit_feature_regression(frame)
    assert scored.count() == frame.where("split = 'test'").count() > 0
    last = frame.orderBy("date", ascending=False).first()
    weights = list(model.coefficients)
    x = model.intercept + sum(w * last[c] for w, c in zip(weights, SCALED_FEATURES))
    expected = []
    for _ in range(4):
        expected.append(x * (last.max_close - last.min_close) + last.min_close)
        x = model.intercept + weights[SCALED_FEATURES.index("close_scaled")] * x
    got = feature_forecast(frame, model, "close", horizon=4).orderBy("step").collect()
    assert [r.step for r in got] == [1, 2, 3, 4] and got[0].date == last.date + dt.timedelta(days=1)
    assert all(abs(r.predicted_close - e) < 1e-9 for r, e in zip(got, expected))
    assert feature_forecast(frame, model, "close", horizon=1).count() == 1


def test_feature_regression_needs_the_previous_rows(spark):
    import pytest

    from barframe.operators.modeling import fit_feature_regression, model_frame
    from tests.conftest import series

    with pytest.raises(ValueError):
        fit_feature_regression(model_frame(series(spark, [1.0 + i % 5 for i in range(60)]), "close"))


def test_feature_forecast_makes_the_frame_once(spark):
    import barframe.plans.catalog_jobs  # noqa: F401  (registers the query)
    from barframe.plans.catalog import QUERIES
    from tests.conftest import SF001

    plan = QUERIES["feature_forecast"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortAggregate" not in plan
