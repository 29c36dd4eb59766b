"""More queries of the catalog: models of each series. Importing the module registers them."""

from __future__ import annotations

from pyspark.sql import functions as F

from barframe.operators.indicators import FEATURES, indicators
from barframe.operators.modeling import SCALED_FEATURES, evaluate, min_max_scale, model_frame
from barframe.operators.ridge import PENALTIES, fit_series_regression, series_forecast, series_predictions
from barframe.operators.sequence_store import pack_sequences, read_sequences, write_sequences
from barframe.plans.catalog import SQL_CHECKSUM, checksummed, register, rounded, sql_elimination, sql_model_ctes, sql_round, with_bars
from barframe.plans.workspace import scratch_path
from barframe.sources.fixtures import bars_supplier

_N = len(FEATURES)
_OWN = FEATURES.index("close") + 1


def sql_series_fit() -> list[str]:
    """The ridge regression of each series as CTEs: ``rw`` (rows), ``fit`` (status, penalty, coefficients ``b``)."""
    xs = [f"x{i}" for i in range(1, _N + 1)]
    lagged = ", ".join(f"lag({c}) OVER w AS x{i}" for i, c in enumerate(SCALED_FEATURES, 1))
    cells = ["1.0::DOUBLE", *xs, "y"]
    gram = ", ".join("[" + ", ".join(f"sum({a} * {b})" for b in cells) + "]" for a in cells)
    constant = " + ".join(f"CAST(max({x}) = min({x}) AS INTEGER)" for x in xs)
    grid = ", ".join(f"({p}::DOUBLE)" for p in PENALTIES)
    return [
        *sql_model_ctes(),
        f"lg AS (SELECT ticker, date, {lagged} FROM sc WINDOW w AS (PARTITION BY ticker ORDER BY date))",
        f"""rw AS MATERIALIZED (SELECT fr.ticker, fr.date, split, label AS y, prev_target, min_close, max_close, {', '.join(xs)}
FROM fr JOIN lg USING (ticker, date) WHERE {' AND '.join(f'{x} IS NOT NULL' for x in xs)})""",
        f"gm AS MATERIALIZED (SELECT ticker, split, count(*) AS n, {constant} AS constant, [{gram}] AS g FROM rw GROUP BY ticker, split)",
        f"""eq AS (SELECT ticker, penalty, list_transform(g[1:{_N + 1}], lambda row, i: list_transform(row, lambda v, j:
  CASE WHEN i = j AND i > 1 THEN v + penalty * n ELSE v END)) AS m FROM gm, (VALUES {grid}) p(penalty) WHERE split = 'train')""",
        *sql_elimination("eq", _N + 1),
        f"so AS (SELECT ticker, penalty, list_transform(m, lambda row: row[{_N + 2}]) AS b FROM eq_{_N + 1})",
        """er AS (SELECT so.*, n, greatest(list_sum(list_transform(list_zip(g, list_append(b, -1.0)), lambda z:
  z[2] * list_dot_product(z[1], list_append(b, -1.0)))), 0) / n AS mse FROM so LEFT JOIN (SELECT * FROM gm WHERE split = 'validation') USING (ticker))""",
        """be AS (SELECT * FROM er QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY mse, CASE WHEN n IS NULL THEN -penalty ELSE penalty END) = 1)""",
        f"""fit AS MATERIALIZED (SELECT ticker, CASE WHEN tr.n IS NULL THEN 'no fit' WHEN be.n IS NULL THEN 'no validation'
  WHEN tr.n < {_N + 1} OR constant > 0 THEN 'singular' ELSE 'ok' END AS status, coalesce(tr.n, 0) AS n_train, coalesce(va.n, 0) AS n_validation,
  penalty, mse, b FROM (SELECT DISTINCT ticker FROM gm) LEFT JOIN (SELECT ticker, n, constant FROM gm WHERE split = 'train') tr USING (ticker)
  LEFT JOIN (SELECT ticker, n FROM gm WHERE split = 'validation') va USING (ticker) LEFT JOIN be USING (ticker))""",
    ]


def _fitted(spark, sf):
    frame = model_frame(bars_supplier(spark, sf), "close", previous=SCALED_FEATURES)
    return frame, fit_series_regression(frame)


_B = [f"b{i}" for i in range(_N + 1)]


@register(
    "series_regression",
    with_bars(
        "supplier",
        f"""SELECT ticker, status, n_train, n_validation, penalty, {sql_round('mse')} AS validation_mse,
  {', '.join(f"{sql_round(f'b[{i + 1}]')} AS {c}" for i, c in enumerate(_B))} FROM fit""",
        *sql_series_fit(),
    ),
)
def q_series_regression(spark, sf):
    """A regression of every series on all features, its penalty chosen on the validation part."""
    _frame, fits = _fitted(spark, sf)
    columns = [F.get("coefficients", F.lit(i)).alias(c) for i, c in enumerate(_B)]
    out = fits.select("ticker", "status", "n_train", "n_validation", "penalty", "validation_mse", *columns)
    return rounded(out, {"validation_mse": 6, **{c: 6 for c in _B}})


_SQL_SCORED = f"""ts AS (SELECT ticker, date, y, prev_target, min_close, max_close, b[1] + {' + '.join(f'b[{i + 1}] * x{i}' for i in range(1, _N + 1))} AS p
FROM rw JOIN fit USING (ticker) WHERE split = 'test' AND b IS NOT NULL)"""
_UNSCALED = lambda c: f"{c} * (max_close - min_close) + min_close"


@register(
    "series_regression_predictions",
    with_bars(
        "supplier",
        f"""SELECT ticker, date, {sql_round(_UNSCALED('y'))} AS actual, {sql_round(_UNSCALED('p'), 2)} AS predicted,
  {sql_round(_UNSCALED('prev_target'))} AS last_value FROM ts""",
        *sql_series_fit(),
        _SQL_SCORED,
    ),
)
def q_series_regression_predictions(spark, sf):
    """M4, M5: test predictions of every series by its own regression."""
    frame, fits = _fitted(spark, sf)
    return rounded(series_predictions(frame, fits), {"actual": 6, "predicted": 2, "last_value": 6})


@register(
    "series_regression_metrics",
    with_bars(
        "supplier",
        f"""SELECT ticker, count(*) AS n_test, {sql_round('sqrt(avg(e * e))', 2)} AS rmse, {sql_round('avg(abs(e))', 2)} AS mae
FROM (SELECT ticker, ({_UNSCALED('p')}) - ({_UNSCALED('y')}) AS e FROM ts) GROUP BY ticker""",
        *sql_series_fit(),
        _SQL_SCORED,
    ),
)
def q_series_regression_metrics(spark, sf):
    """A9 over the regressions of all series."""
    frame, fits = _fitted(spark, sf)
    return rounded(evaluate(series_predictions(frame, fits)).select("ticker", "n_test", "rmse", "mae"), {"rmse": 2, "mae": 2})


@register(
    "series_regression_forecast",
    with_bars(
        "supplier",
        f"""SELECT ticker, CAST(step AS INTEGER) AS step, CAST(last_date + CAST(step AS INTEGER) AS DATE) AS date,
  {sql_round('x * (max_close - min_close) + min_close', 2)} AS predicted_close FROM path JOIN st USING (ticker)""",
        *sql_series_fit(),
        f"""st AS (SELECT ticker, max(date) AS last_date, first(min_close) AS min_close, first(max_close) AS max_close,
  {', '.join(f'arg_max({c}, date) AS f{i}' for i, c in enumerate(SCALED_FEATURES, 1))} FROM fr GROUP BY ticker)""",
        f"""s1 AS (SELECT ticker, b[1] + {' + '.join(f'b[{i + 1}] * f{i}' for i in range(1, _N + 1))} AS x, b[1] AS base, b[{_OWN + 1}] AS own
FROM st JOIN fit USING (ticker) WHERE b IS NOT NULL)""",
        """path AS (SELECT * FROM (WITH RECURSIVE it(ticker, step, x, base, own) AS (
    SELECT ticker, 1, x, base, own FROM s1
    UNION ALL
    SELECT ticker, step + 1, base + own * x, base, own FROM it WHERE step < 30)
  SELECT ticker, step, x FROM it))""",
    ),
)
def q_series_regression_forecast(spark, sf):
    """M6, M7, M8: thirty days ahead for every series by its own regression."""
    frame, fits = _fitted(spark, sf)
    return rounded(series_forecast(frame, fits), {"predicted_close": 2})


@register(
    "sequence_store",
    with_bars(
        "supplier",
        f"""SELECT ticker, date, seq_len, pos, CAST(seq_len AS INTEGER) AS n_steps, {SQL_CHECKSUM} AS checksum,
  {sql_round('label', 9)} AS label FROM seqs""",
        *sql_model_ctes(hist=True)[:-2],
    ),
)
def q_sequence_store(spark, sf):
    """The sequences written as blocks of rows, and sliced when they are read back."""
    path = scratch_path(spark, "sequences")
    scaled = min_max_scale(indicators(bars_supplier(spark, sf)), FEATURES)
    write_sequences(pack_sequences(scaled, SCALED_FEATURES, "close_scaled"), path)
    return rounded(checksummed(read_sequences(spark, path)), {"label": 9})
