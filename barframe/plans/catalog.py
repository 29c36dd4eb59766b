"""Query catalog: each operator of SURVEY §2 as a query over the driver tables, with its DuckDB oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE_SQL[name]`` (DuckDB over the views
``lineitem``, ``events``, ``supplier`` …). Column names match on both sides.

Comparison rules (floating point differs between engines in summation order):

* bars, counts, dates, strings and values computed by the same IEEE operations compare exactly;
* means of values with at most 4 decimals use the exact decimal-sum mean on both sides;
* other derived doubles are rounded on both sides — 6 decimals (9 for [0,1]-scaled values,
  2 for prices that pass through a fitted model, 4 for means over noisy copies). Spark rounds the
  shortest decimal form of a double half-up; the oracle reproduces that through a decimal cast
  of the text form (``sql_round``).
* DuckDB's ``year``/``month``/``dayofweek`` are BIGINT with Sunday = 0: the oracle casts and adds 1.

Fixture choice: ``bars_supplier`` (one series per supplier; grows with the scale factor) for
most operators; ``bars_lineitem`` (three long, dense series) where intraday range matters;
``bars_events`` (five one-month series) for the round trips of small layouts.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barframe.operators.aggregate import (
    describe_bars,
    describe_before_after,
    distinct_sorted,
    series_stats,
    yearly_summary,
)
from barframe.operators.blocked import indicators_between, indicators_blocked, model_frame_blocked
from barframe.operators.charts import close_by_year, close_history, volatility_by_ticker
from barframe.operators.clean import (
    coverage_report,
    filter_outliers,
    missing_tickers,
    rejected_rows,
    restrict_dates,
    select_series,
)
from barframe.operators.enrich import add_volatility, enrich, tag_ticker
from barframe.operators.indicators import FEATURES, add_moving_averages, add_price_changes, add_rsi, indicators
from barframe.operators.modeling import (
    ar1_coefficients,
    ar1_predictions,
    chronological_split,
    evaluate,
    N_LAGS,
    fit_lag_regression,
    forecast_status,
    inverse_scale,
    last_rows,
    make_sequences,
    min_max_scale,
    model_frame,
    recursive_forecast,
    sequence_length,
)
from barframe.operators.multiply import multiply_bars
from barframe.operators.union import union_by_name
from barframe.plans import jobs
from barframe.plans.workspace import scratch_path
from barframe.sources.fixtures import bars_events, bars_lineitem, bars_supplier, expected_suppliers
from barframe.sources.readers import read_bars_json, read_bars_parquet, read_wrapped_json
from barframe.streaming.ingest import run_available
from barframe.sources.writers import (
    to_json_records,
    write_bucketed_bars,
    write_json_arrays,
    write_line_json,
    write_parquet,
    write_text,
    write_wrapped_json,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

BAR_COLS = ["ticker", "date", "open", "high", "low", "close", "volume"]
COPIES_LARGE = 500  # the reference's own count, in the aggregated multiplication query
SEED = 42


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn

    return deco


def rnd(c, d: int = 6) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, d)


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.withColumns({c: rnd(c, d) for c, d in digits.items()})


# ================================================================== oracle building blocks (DuckDB)


def sql_round(expr: str, d: int = 6) -> str:
    """Spark's ``round(double, d)``: half-up on the shortest decimal text of the double."""
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,18)), {d}) AS DOUBLE)"


def sql_exact_mean(expr: str) -> str:
    return f"CAST(sum(CAST(({expr}) AS DECIMAL(18,4))) AS DOUBLE) / count({expr})"


def _bars_sql(src: str, ticker: str, ts: str, price: str, key: str, volume: str) -> str:
    return f"""SELECT {ticker} AS ticker, CAST({ts} AS DATE) AS date,
       arg_min({price}, {key}) AS open, max({price}) AS high, min({price}) AS low,
       arg_max({price}, {key}) AS close, CAST({volume} AS DOUBLE) AS volume
FROM {src} GROUP BY ALL"""


LI_KEY = "(l_orderkey, l_linenumber, l_extendedprice)"
SQL_BARS = {
    "lineitem": _bars_sql("lineitem", "l_returnflag", "l_shipdate", "l_extendedprice", LI_KEY, "sum(l_quantity)"),
    "supplier": _bars_sql("lineitem", "CAST(l_suppkey AS VARCHAR)", "l_shipdate", "l_extendedprice", LI_KEY, "sum(l_quantity)"),
    "events": _bars_sql("events", "event_type", "ts", "value", "(ts, event_id)", "count(*)"),
}
FIXTURE = {"lineitem": bars_lineitem, "supplier": bars_supplier, "events": bars_events}

SQL_STRICT = (
    "open > 0 AND open < 100000 AND high > 0 AND high < 100000 AND low > 0 AND low < 100000 "
    "AND close > 0 AND close < 100000 AND volume >= 0"
)
SQL_CLOSE_VOLUME = "close > 0 AND close < 100000 AND volume >= 0"
SQL_PROFILE = {"strict": SQL_STRICT, "close_volume": SQL_CLOSE_VOLUME}


def with_bars(fixture: str, body: str, *ctes: str) -> str:
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH bars AS ({SQL_BARS[fixture]}){extra}\n{body}"


def sql_enrich(src: str, returns: bool = True) -> str:
    ret = f", {sql_round('(close - open) / nullif(open, 0) * 100', 2)} AS daily_return" if returns else ""
    return f"""SELECT *, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
       CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week{ret},
       {sql_round('(high - low) / nullif(open, 0) * 100', 2)} AS intra_day_volatility
FROM {src}"""


def written(spark, df: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table of the work folder, for plans that read it in several branches."""
    path = scratch_path(spark, name)
    write_parquet(df, path)
    return read_bars_parquet(spark, path, df.schema)


def _clean_enriched(spark, sf, fixture: str, profile: str = "strict", returns: bool = True) -> DataFrame:
    return enrich(filter_outliers(FIXTURE[fixture](spark, sf), profile), returns=returns)


# ================================================================== fixtures


for _fx in ("lineitem", "supplier", "events"):

    def _make(fx):
        def q(spark, sf):
            return FIXTURE[fx](spark, sf)

        q.__name__ = f"q_bars_{fx}"
        return q

    register(f"bars_{_fx}", SQL_BARS[_fx])(_make(_fx))


# ================================================================== filters and validation


@register("clean_strict", with_bars("supplier", f"SELECT * FROM bars WHERE {SQL_STRICT}"))
def q_clean_strict(spark, sf):
    """keep bars with every price in (0, 100000) and volume >= 0."""
    return filter_outliers(bars_supplier(spark, sf), "strict")


@register("clean_close_volume", with_bars("supplier", f"SELECT * FROM bars WHERE {SQL_CLOSE_VOLUME}"))
def q_clean_close_volume(spark, sf):
    """bound close and volume only."""
    return filter_outliers(bars_supplier(spark, sf), "close_volume")


def _sql_reason(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '{c}:null' WHEN NOT ({c} > 0 AND {c} < 100000) THEN '{c}:out_of_range' END"


@register(
    "rejects_strict",
    with_bars(
        "lineitem",
        f"""SELECT *, concat_ws(',', {_sql_reason('open')}, {_sql_reason('high')}, {_sql_reason('low')}, {_sql_reason('close')},
       CASE WHEN volume IS NULL THEN 'volume:null' WHEN volume < 0 THEN 'volume:below_min' END) AS reasons
FROM bars WHERE NOT coalesce({SQL_STRICT}, false)""",
    ),
)
def q_rejects_strict(spark, sf):
    """rows the strict profile removes, with the reasons."""
    return rejected_rows(bars_lineitem(spark, sf), "strict")


@register("date_range", with_bars("supplier", "SELECT * FROM bars WHERE date >= DATE '1996-01-01' AND date < DATE '1998-01-01'"))
def q_date_range(spark, sf):
    """History range, start inclusive, end exclusive."""
    return restrict_dates(bars_supplier(spark, sf), "1996-01-01", "1998-01-01")


@register(
    "select_ticker_year",
    with_bars("lineitem", "SELECT * FROM enr WHERE ticker = 'R' AND year = 1996", f"clean AS (SELECT * FROM bars WHERE {SQL_STRICT})", f"enr AS ({sql_enrich('clean')})"),
)
def q_select_ticker_year(spark, sf):
    """F8: one ticker and one year of the enriched table."""
    return select_series(_clean_enriched(spark, sf, "lineitem"), ticker="R", year=1996)


@register(
    "coverage_report",
    with_bars(
        "supplier",
        """SELECT e.ticker, coalesce(c.n_bars, 0) AS n_bars, coalesce(c.n_clean, 0) AS n_clean,
       CASE WHEN coalesce(c.n_bars, 0) = 0 THEN 'no data' WHEN coalesce(c.n_clean, 0) = 0 THEN 'no clean data' ELSE 'ok' END AS status
FROM e LEFT JOIN c USING (ticker)""",
        f"c AS (SELECT ticker, count(*) AS n_bars, count(*) FILTER (WHERE coalesce({SQL_STRICT}, false)) AS n_clean FROM bars GROUP BY ticker)",
        "e AS (SELECT DISTINCT CAST(s_suppkey AS VARCHAR) AS ticker FROM supplier)",
    ),
)
def q_coverage_report(spark, sf):
    """Every expected supplier with its raw and clean bar counts and a status."""
    return coverage_report(expected_suppliers(spark, sf), bars_supplier(spark, sf), "strict")


@register(
    "missing_tickers",
    with_bars(
        "supplier",
        f"SELECT DISTINCT CAST(s_suppkey AS VARCHAR) AS ticker FROM supplier WHERE CAST(s_suppkey AS VARCHAR) NOT IN (SELECT ticker FROM bars WHERE {SQL_STRICT})",
    ),
)
def q_missing_tickers(spark, sf):
    """V1: expected suppliers without a single clean bar (left anti join)."""
    return missing_tickers(expected_suppliers(spark, sf), filter_outliers(bars_supplier(spark, sf), "strict"))


def gapped_bars(spark, sf: str) -> DataFrame:
    """Supplier bars of which the tickers that end in 3 have no plausible close."""
    bars = bars_supplier(spark, sf)
    return bars.withColumn("close", F.when(F.col("ticker").endswith("3"), -F.col("close")).otherwise(F.col("close")))


def listed_tickers(spark, sf: str) -> DataFrame:
    """A list longer than the bars: every part key."""
    return spark.read.parquet(f"{sf}/part.parquet").select(F.col("p_partkey").cast("string").alias("ticker"))


SQL_GAPPED = [
    "gb AS (SELECT ticker, date, open, high, low, CASE WHEN ticker LIKE '%3' THEN -close ELSE close END AS close, volume FROM bars)",
    f"gk AS (SELECT ticker, count(*) AS n_bars, count(*) FILTER (WHERE {SQL_STRICT}) AS n_clean FROM gb GROUP BY ticker)",
    "ge AS (SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS ticker FROM part)",
]


@register(
    "coverage_gaps",
    with_bars(
        "supplier",
        """SELECT ticker, CAST(coalesce(n_bars, 0) AS BIGINT) AS n_bars, CAST(coalesce(n_clean, 0) AS BIGINT) AS n_clean,
  CASE WHEN coalesce(n_bars, 0) = 0 THEN 'no data' WHEN n_clean = 0 THEN 'no clean data' ELSE 'ok' END AS status
FROM ge LEFT JOIN gk USING (ticker)""",
        *SQL_GAPPED,
    ),
)
def q_coverage_gaps(spark, sf):
    """V1, F6, F7, E3 over a list with true gaps: all three statuses occur."""
    return coverage_report(listed_tickers(spark, sf), gapped_bars(spark, sf), "strict")


@register("missing_tickers_gaps", with_bars("supplier", "SELECT ticker FROM ge WHERE ticker NOT IN (SELECT ticker FROM gb)", *SQL_GAPPED))
def q_missing_tickers_gaps(spark, sf):
    """V1 over a list with true gaps."""
    return missing_tickers(listed_tickers(spark, sf), gapped_bars(spark, sf))


# ================================================================== enrichment


@register("enrich_bars", with_bars("supplier", "SELECT * FROM enr", f"clean AS (SELECT * FROM bars WHERE {SQL_STRICT})", f"enr AS ({sql_enrich('clean')})"))
def q_enrich_bars(spark, sf):
    """Calendar, daily return and intraday volatility (2 dp) on the strict-clean bars."""
    return _clean_enriched(spark, sf, "supplier")


@register(
    "enrich_close_volume",
    with_bars("lineitem", "SELECT * FROM enr", f"clean AS (SELECT * FROM bars WHERE {SQL_CLOSE_VOLUME})", f"enr AS ({sql_enrich('clean', returns=False)})"),
)
def q_enrich_close_volume(spark, sf):
    """P6-P8, P10 with the close/volume profile and no daily return (large-data variant)."""
    return _clean_enriched(spark, sf, "lineitem", "close_volume", returns=False)


@register(
    "volatility_unrounded",
    with_bars("lineitem", "SELECT *, (high - low) / nullif(open, 0) * 100 AS volatility_pct, (high - low) / nullif(open, 0) AS volatility FROM bars"),
)
def q_volatility_unrounded(spark, sf):
    """Unrounded intraday volatility in percent and as a ratio."""
    return add_volatility(bars_lineitem(spark, sf))


@register("tagged_bars", f"SELECT 'EVENTS' AS ticker, * EXCLUDE (ticker) FROM ({SQL_BARS['events']})")
def q_tagged_bars(spark, sf):
    """A table read without a ticker column, tagged with a constant ticker."""
    return tag_ticker(bars_events(spark, sf).drop("ticker"), "EVENTS")


# ================================================================== aggregates


def _sql_yearly(fixture: str, profile: str = "strict", raw_vol: bool = False) -> str:
    vol = f"{sql_round('avg((high - low) / nullif(open, 0) * 100)')}" if raw_vol else sql_exact_mean("intra_day_volatility")
    return with_bars(
        fixture,
        f"SELECT year, ticker, {sql_exact_mean('close')} AS avg_close, {vol} AS avg_volatility FROM enr GROUP BY year, ticker",
        f"clean AS (SELECT * FROM bars WHERE {SQL_PROFILE[profile]})",
        f"enr AS ({sql_enrich('clean')})",
    )


def _yearly(spark, sf, fixture: str, profile: str = "strict", raw_vol: bool = False) -> DataFrame:
    y = yearly_summary(_clean_enriched(spark, sf, fixture, profile), volatility="raw" if raw_vol else "rounded", exact=True)
    return rounded(y, {"avg_volatility": 6}) if raw_vol else y


@register("yearly_summary", _sql_yearly("lineitem"))
def q_yearly_summary(spark, sf):
    """A1 + A2 (flagship): mean close and mean rounded volatility per (year, ticker), one groupBy."""
    return _yearly(spark, sf, "lineitem")


@register("yearly_summary_suppliers", _sql_yearly("supplier"))
def q_yearly_summary_suppliers(spark, sf):
    """A1 + A2 over every supplier series."""
    return _yearly(spark, sf, "supplier")


@register("yearly_raw_volatility", _sql_yearly("lineitem", "close_volume", raw_vol=True))
def q_yearly_raw_volatility(spark, sf):
    """A3: mean of the *unrounded* volatility per (year, ticker)."""
    return _yearly(spark, sf, "lineitem", "close_volume", raw_vol=True)


def _sql_describe(src: str, stage: str | None, cond: str | None) -> str:
    parts = []
    for c in ["open", "high", "low", "close", "volume"]:
        v = f"CASE WHEN {cond} THEN {c} END" if cond else c
        st = f"'{stage}' AS stage, " if stage else ""
        parts.append(
            f"SELECT {st}'{c}' AS field, count({v}) AS count, {sql_exact_mean(v)} AS mean, "
            f"{sql_round(f'stddev_samp({v})')} AS stddev, min({v}) AS min, max({v}) AS max FROM {src}"
        )
    return "\nUNION ALL\n".join(parts)


@register("describe_bars", with_bars("lineitem", _sql_describe("bars", None, None)))
def q_describe_bars(spark, sf):
    """A4: typed count / mean / sample stddev / min / max of the five bar columns."""
    return rounded(describe_bars(bars_lineitem(spark, sf), exact=True), {"stddev": 6})


@register(
    "describe_before_after",
    with_bars(
        "lineitem",
        _sql_describe("bars", "before", None) + "\nUNION ALL\n" + _sql_describe("bars", "after", f"coalesce({SQL_STRICT}, false)"),
    ),
)
def q_describe_before_after(spark, sf):
    """A5: the same profile before and after strict cleaning, from one scan."""
    return rounded(describe_before_after(bars_lineitem(spark, sf), "strict", exact=True), {"stddev": 6})


@register("distinct_years", with_bars("supplier", "SELECT DISTINCT CAST(year(date) AS INTEGER) AS year FROM bars"))
def q_distinct_years(spark, sf):
    """Distinct years, sorted."""
    return distinct_sorted(bars_supplier(spark, sf).withColumn("year", F.year("date")), "year")


@register("distinct_tickers", with_bars("supplier", "SELECT DISTINCT ticker FROM bars"))
def q_distinct_tickers(spark, sf):
    """Distinct tickers, sorted."""
    return distinct_sorted(bars_supplier(spark, sf), "ticker")


@register(
    "series_stats",
    with_bars(
        "supplier",
        "SELECT ticker, count(*) AS n_rows, min(date) AS first_date, max(date) AS last_date, min(close) AS min_close, max(close) AS max_close FROM bars GROUP BY ticker",
    ),
)
def q_series_stats(spark, sf):
    """Rows, first/last date and close range per series."""
    return series_stats(bars_supplier(spark, sf))


# ================================================================== sorts, limits, charts


@register(
    "top10_yearly",
    with_bars(
        "supplier",
        f"SELECT year, ticker, {sql_exact_mean('close')} AS avg_close FROM enr GROUP BY year, ticker ORDER BY year, ticker LIMIT 10",
        f"clean AS (SELECT * FROM bars WHERE {SQL_STRICT})",
        f"enr AS ({sql_enrich('clean')})",
    ),
)
def q_top10_yearly(spark, sf):
    """O1: yearly means sorted by (year, ticker), first ten rows (a top-k report)."""
    return _yearly(spark, sf, "supplier").orderBy("year", "ticker").select("year", "ticker", "avg_close").limit(10)


@register("preview_bars", with_bars("supplier", "SELECT * FROM bars ORDER BY ticker, date LIMIT 5"))
def q_preview_bars(spark, sf):
    """K8: first five bars in (ticker, date) order."""
    return bars_supplier(spark, sf).orderBy("ticker", "date").limit(5)


@register(
    "chart_close_by_year",
    with_bars(
        "supplier",
        f"SELECT ticker, year, {sql_exact_mean('close')} AS avg_close FROM enr GROUP BY ticker, year",
        f"clean AS (SELECT * FROM bars WHERE {SQL_STRICT})",
        f"enr AS ({sql_enrich('clean')})",
    ),
)
def q_chart_close_by_year(spark, sf):
    """C1 + O2: one line per ticker, mean close by year, sorted by (ticker, year)."""
    return close_by_year(_yearly(spark, sf, "supplier"))


@register(
    "chart_volatility_by_ticker",
    with_bars(
        "lineitem",
        f"SELECT year, ticker, {sql_exact_mean('intra_day_volatility')} AS avg_volatility FROM enr GROUP BY year, ticker",
        f"clean AS (SELECT * FROM bars WHERE {SQL_STRICT})",
        f"enr AS ({sql_enrich('clean')})",
    ),
)
def q_chart_volatility_by_ticker(spark, sf):
    """C2 + O3: one line per year, mean volatility by ticker, sorted by (year, ticker)."""
    return volatility_by_ticker(_yearly(spark, sf, "lineitem"))


@register("chart_close_history", with_bars("events", "SELECT ticker, date, close FROM bars"))
def q_chart_close_history(spark, sf):
    """C3 + O4: close history of every series, sorted by date."""
    return close_history(bars_events(spark, sf))


# ================================================================== windows


def _sql_window_base(src: str = "bars") -> str:
    """Lags, deltas and rolling frames of the indicator frame (everything but RSI's final step)."""
    return f"""SELECT *,
  CASE WHEN count(close) OVER f5 = 5 THEN avg(close) OVER f5 END AS ma5,
  CASE WHEN count(close) OVER f20 = 20 THEN avg(close) OVER f20 END AS ma20,
  close / nullif(lag(close) OVER s, 0) - 1 AS price_change,
  close / nullif(lag(close, 5) OVER s, 0) - 1 AS price_change_5d,
  volume / nullif(lag(volume) OVER s, 0) - 1 AS volume_change,
  (high - low) / nullif(open, 0) AS volatility
FROM {src}
WINDOW s AS (PARTITION BY ticker ORDER BY date),
       f5 AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
       f20 AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"""


SQL_RSI_CTES = [
    """d AS (SELECT *, close - lag(close) OVER (PARTITION BY ticker ORDER BY date) AS delta FROM w1)""",
    """g AS (SELECT *, CASE WHEN delta > 0 THEN delta ELSE 0.0 END AS gain, CASE WHEN delta < 0 THEN -delta ELSE 0.0 END AS loss FROM d)""",
    """m AS (SELECT *,
  CASE WHEN count(gain) OVER f14 = 14 THEN avg(gain) OVER f14 END AS ag,
  CASE WHEN count(loss) OVER f14 = 14 THEN avg(loss) OVER f14 END AS al
FROM g WINDOW f14 AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW))""",
    """ind AS (SELECT * EXCLUDE (delta, gain, loss, ag, al),
  CASE WHEN al = 0 THEN CASE WHEN ag > 0 THEN 100.0 END ELSE 100 - 100 / (1 + ag / al) END AS rsi FROM m)""",
]


def sql_indicator_ctes(fixture_src: str = "bars", dropna: bool = True) -> list[str]:
    ctes = [f"w1 AS ({_sql_window_base(fixture_src)})"] + SQL_RSI_CTES
    if dropna:
        cond = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in FEATURES)
        ctes.append(f"ind_clean AS (SELECT * FROM ind WHERE {cond})")
    return ctes


@register(
    "moving_averages",
    with_bars("supplier", f"SELECT ticker, date, close, {sql_round('ma5')} AS ma5, {sql_round('ma20')} AS ma20 FROM w1", f"w1 AS ({_sql_window_base()})"),
)
def q_moving_averages(spark, sf):
    """5- and 20-row means of close, NULL until the window is full."""
    out = add_moving_averages(bars_supplier(spark, sf)).select("ticker", "date", "close", "ma5", "ma20")
    return rounded(out, {"ma5": 6, "ma20": 6})


@register(
    "price_changes",
    with_bars(
        "supplier",
        f"SELECT ticker, date, {sql_round('price_change')} AS price_change, {sql_round('price_change_5d')} AS price_change_5d, {sql_round('volume_change')} AS volume_change FROM w1",
        f"w1 AS ({_sql_window_base()})",
    ),
)
def q_price_changes(spark, sf):
    """Relative changes of close (1 and 5 rows) and volume; NULL on a zero base."""
    out = add_price_changes(bars_supplier(spark, sf)).select("ticker", "date", "price_change", "price_change_5d", "volume_change")
    return rounded(out, {"price_change": 6, "price_change_5d": 6, "volume_change": 6})


@register(
    "rsi",
    with_bars("supplier", f"SELECT ticker, date, close, {sql_round('rsi')} AS rsi FROM ind", *sql_indicator_ctes(dropna=False)),
)
def q_rsi(spark, sf):
    """RSI with simple 14-row means of gains and losses."""
    return rounded(add_rsi(bars_supplier(spark, sf)).select("ticker", "date", "close", "rsi"), {"rsi": 6})


_IND_DERIVED = ["ma5", "ma20", "price_change", "price_change_5d", "volume_change", "volatility", "rsi"]


@register(
    "indicators",
    with_bars(
        "lineitem",
        "SELECT ticker, date, open, high, low, close, volume, " + ", ".join(f"{sql_round(c)} AS {c}" for c in _IND_DERIVED) + " FROM ind_clean",
        *sql_indicator_ctes(),
    ),
)
def q_indicators(spark, sf):
    """The whole indicator frame (12 features), rows with a missing feature dropped."""
    out = indicators(bars_lineitem(spark, sf)).select(*BAR_COLS, *_IND_DERIVED)
    return rounded(out, {c: 6 for c in _IND_DERIVED})


@register(
    "indicators_blocked",
    with_bars(
        "lineitem",
        "SELECT ticker, date, open, high, low, close, volume, " + ", ".join(f"{sql_round(c)} AS {c}" for c in _IND_DERIVED) + " FROM ind_clean",
        *sql_indicator_ctes(),
    ),
)
def q_indicators_blocked(spark, sf):
    """W10 for long series: each series cut into calendar-year blocks with a 20-row halo, windows per
    (ticker, year) — the three return-flag series each hold a third of the rows."""
    out = indicators_blocked(written(spark, bars_lineitem(spark, sf), "bars")).select(*BAR_COLS, *_IND_DERIVED)
    return rounded(out, {c: 6 for c in _IND_DERIVED})


@register(
    "indicators_recent",
    with_bars(
        "supplier",
        "SELECT ticker, date, open, high, low, close, volume, " + ", ".join(f"{sql_round(c)} AS {c}" for c in _IND_DERIVED)
        + " FROM ind_clean WHERE date >= DATE '2001-01-01' AND date < DATE '2001-07-01'",
        *sql_indicator_ctes(),
    ),
)
def q_indicators_recent(spark, sf):
    """W10 for one half-year only (date range and the 20 rows before it, taken before the windows)
    — equal to the full frame filtered afterwards."""
    out = indicators_between(bars_supplier(spark, sf), "2001-01-01", "2001-07-01").select(*BAR_COLS, *_IND_DERIVED)
    return rounded(out, {c: 6 for c in _IND_DERIVED})


@register(
    "indicators_bucketed",
    with_bars(
        "supplier",
        "SELECT ticker, date, open, high, low, close, volume, " + ", ".join(f"{sql_round(c)} AS {c}" for c in _IND_DERIVED) + " FROM ind_clean",
        *sql_indicator_ctes(),
    ),
)
def q_indicators_bucketed(spark, sf):
    """W10 over a bar table written bucketed by ticker (sorted by date in each bucket): the
    windows read partitions already hash-partitioned on the series key — no exchange."""
    table = f"barframe_bars_{uuid.uuid4().hex[:12]}"
    write_bucketed_bars(bars_supplier(spark, sf), table, scratch_path(spark, "bucketed"), buckets=16, keys=["ticker"])
    out = indicators(spark.table(table)).select(*BAR_COLS, *_IND_DERIVED)
    return rounded(out, {c: 6 for c in _IND_DERIVED})


# ================================================================== modelling


def sql_model_ctes(target: str = "close", bounds_where: str = "", hist: bool = False) -> list[str]:
    """Indicators → per-series min-max scaling → sequence positions → split (DuckDB); ``hist``: with the sequences' steps."""
    steps = f"""list([{', '.join(f'{c}_scaled' for c in FEATURES)}]) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING) AS hist"""
    bounds = ", ".join(f"{f}({c}){bounds_where} OVER p AS {f}_{c}" for c in FEATURES for f in ("min", "max"))
    scaled = ", ".join(
        f"CASE WHEN max_{c} > min_{c} THEN ({c} - min_{c}) / (max_{c} - min_{c}) ELSE 0.0 END AS {c}_scaled" for c in FEATURES
    )
    return sql_indicator_ctes() + [
        """pz AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date) - 1 AS place, count(*) OVER (PARTITION BY ticker) AS n
FROM ind_clean)""",
        "pq AS (SELECT *, n - ceil((n - least(60, floor(n * 0.2::DOUBLE))) * 0.2::DOUBLE) AS cutoff FROM pz)",
        f"b AS (SELECT * EXCLUDE (place, cutoff), {bounds} FROM pq WINDOW p AS (PARTITION BY ticker))",
        f"sc AS (SELECT *, {scaled} FROM b)",
        f"""sq AS (SELECT *, CAST(least(60, floor(n * 0.2::DOUBLE)) AS INTEGER) AS seq_len,
  CAST(row_number() OVER s - 1 AS INTEGER) AS pos, lag({target}_scaled) OVER s AS prev_target, {target}_scaled AS label{', ' + steps if hist else ''}
FROM sc WINDOW s AS (PARTITION BY ticker ORDER BY date))""",
        "seqs AS (SELECT * FROM sq WHERE seq_len >= 1 AND pos >= seq_len)",
        """sp AS (SELECT *, count(*) OVER (PARTITION BY ticker) AS m, row_number() OVER (PARTITION BY ticker ORDER BY date) AS k FROM seqs)""",
        """fr AS (SELECT *, CASE WHEN k > m - ceil(m * 0.2::DOUBLE) THEN 'test'
  WHEN k > floor((m - ceil(m * 0.2::DOUBLE)) * 0.9::DOUBLE) THEN 'validation' ELSE 'train' END AS split FROM sp)""",
    ]


def _frame(spark, sf, fixture: str = "supplier", with_arrays: bool = False) -> DataFrame:
    bars = FIXTURE[fixture](spark, sf)
    if not with_arrays:
        return model_frame(bars, "close")
    ind = indicators(bars)
    scaled = min_max_scale(ind, FEATURES)
    seqs = make_sequences(scaled, [f"{c}_scaled" for c in FEATURES], "close_scaled", with_arrays=True)
    return chronological_split(seqs)


@register(
    "minmax_scaled",
    with_bars("supplier", "SELECT ticker, date, " + ", ".join(f"{sql_round(c + '_scaled', 9)} AS {c}_scaled" for c in FEATURES) + " FROM sc", *sql_model_ctes()[:-4]),
)
def q_minmax_scaled(spark, sf):
    """Per-series min-max scaling of the 12 features; a constant feature maps to 0."""
    scaled = min_max_scale(indicators(bars_supplier(spark, sf)), FEATURES)
    return rounded(scaled.select("ticker", "date", *[f"{c}_scaled" for c in FEATURES]), {f"{c}_scaled": 9 for c in FEATURES})


@register(
    "inverse_scaled",
    with_bars("supplier", f"SELECT ticker, date, {sql_round('close_scaled * (max_close - min_close) + min_close')} AS close_restored FROM sc", *sql_model_ctes()[:-4]),
)
def q_inverse_scaled(spark, sf):
    """M2: scaled close mapped back to prices."""
    scaled = min_max_scale(indicators(bars_supplier(spark, sf)), FEATURES)
    out = scaled.select("ticker", "date", inverse_scale("close_scaled", "min_close", "max_close").alias("close_restored"))
    return rounded(out, {"close_restored": 6})


#: Every feature of every step, in millionths, times its place in the sequence.
SQL_CHECKSUM = """CAST(list_sum([CAST(floor(v * 1e6::DOUBLE + 0.5::DOUBLE) AS BIGINT) * i
    for v, i in flatten(list_slice(hist, len(hist) - seq_len + 1, len(hist)))]) AS BIGINT)"""


def checksummed(seqs: DataFrame, width: int = len(FEATURES)) -> DataFrame:
    """``ticker, date, seq_len, pos, n_steps, checksum, label`` of sequences whose steps have ``width`` numbers.

    The checksum adds up every number in millionths times its place (from 1); it is NULL if one is NULL. The steps
    become rows that are added up by sequence before any shuffle: this is compiled, while a lambda over the
    hundreds of numbers of a sequence is interpreted. Every sequence has a step at least.
    """
    steps = seqs.select("ticker", "date", "seq_len", "pos", "label", F.size("sequence").cast("int").alias("n_steps"), F.posexplode("sequence").alias("_at", "_step"))
    first = F.col("_at").cast("bigint") * width
    terms = [F.floor(F.get("_step", F.lit(i)) * F.lit(1e6) + F.lit(0.5)).cast("bigint") * (first + (i + 1)) for i in range(width)]
    part = reduce(add, terms)
    whole = F.when(F.count(part) == F.count(F.lit(1)), F.sum(part)).alias("checksum")
    kept = [F.first(c).alias(c) for c in ("date", "seq_len", "n_steps", "label")]
    return steps.groupBy("ticker", "pos").agg(*kept, whole).select("ticker", "date", "seq_len", "pos", "n_steps", "checksum", "label")


@register(
    "sequences",
    with_bars(
        "supplier",
        f"""SELECT ticker, date, seq_len, pos, CAST(seq_len AS INTEGER) AS n_steps,
  {SQL_CHECKSUM} AS checksum,
  {sql_round('label', 9)} AS label FROM seqs""",
        *sql_model_ctes(hist=True)[:-2],
    ),
)
def q_sequences(spark, sf):
    """Sliding sequences of L = min(60, int(0.2 n)) steps and the next-row label."""
    return rounded(checksummed(_frame(spark, sf, with_arrays=True)), {"label": 9})


@register("train_test_split", with_bars("supplier", "SELECT ticker, date, split FROM fr", *sql_model_ctes()))
def q_train_test_split(spark, sf):
    """Chronological train / validation / test labels of the sequences."""
    return _frame(spark, sf).select("ticker", "date", "split")


@register(
    "last_window",
    with_bars(
        "supplier",
        f"""SELECT ticker, date, {sql_round('close_scaled', 9)} AS close_scaled FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS rk, CAST(least(60, floor(n * 0.2::DOUBLE)) AS INTEGER) AS L FROM sc) WHERE rk <= L""",
        *sql_model_ctes()[:-4],
    ),
)
def q_last_window(spark, sf):
    """The last L scaled rows of each series (the seed of the recursive forecast)."""
    scaled = min_max_scale(indicators(bars_supplier(spark, sf)), FEATURES)
    n = F.count(F.lit(1)).over(Window.partitionBy("ticker"))
    tail = last_rows(scaled.withColumn("seq_len", sequence_length(n)), F.col("seq_len"))
    return rounded(tail.select("ticker", "date", "close_scaled"), {"close_scaled": 9})


SQL_AR1_FIT = """co AS (SELECT ticker, regr_slope(CASE WHEN split = 'train' THEN label END, CASE WHEN split = 'train' THEN prev_target END) AS slope,
  regr_intercept(CASE WHEN split = 'train' THEN label END, CASE WHEN split = 'train' THEN prev_target END) AS intercept,
  CAST(regr_count(CASE WHEN split = 'train' THEN label END, CASE WHEN split = 'train' THEN prev_target END) AS BIGINT) AS n_fit
FROM fr GROUP BY ticker)"""


@register(
    "ar1_coefficients",
    with_bars("supplier", f"SELECT ticker, {sql_round('slope')} AS slope, {sql_round('intercept')} AS intercept, n_fit FROM co", *sql_model_ctes(), SQL_AR1_FIT),
)
def q_ar1_coefficients(spark, sf):
    """M3 (a): AR(1) next-day model per series, least squares on the training sequences."""
    co = ar1_coefficients(_frame(spark, sf))
    return rounded(co, {"slope": 6, "intercept": 6})


@register(
    "forecast_status",
    with_bars(
        "lineitem",
        """SELECT ticker, CAST(coalesce(n_rows, 0) AS BIGINT) AS n_rows, coalesce(n_fit, 0) AS n_fit,
  CASE WHEN co.n_fit IS NULL THEN 'too short' WHEN slope IS NULL THEN 'no fit' ELSE 'ok' END AS status
FROM (SELECT DISTINCT ticker FROM bars) LEFT JOIN (SELECT ticker, count(*) AS n_rows FROM sc GROUP BY ticker) USING (ticker) LEFT JOIN co USING (ticker)""",
        *sql_model_ctes(),
        SQL_AR1_FIT,
    ),
)
def q_forecast_status(spark, sf):
    """M8: every series with whether it has a forecast, and if not why."""
    bars = bars_lineitem(spark, sf)
    return forecast_status(bars, model_frame(bars, "close"))


SQL_AR1_PRED = """pr AS (SELECT fr.ticker, fr.date,
  label * (max_close - min_close) + min_close AS actual,
  (co.intercept + co.slope * prev_target) * (max_close - min_close) + min_close AS predicted,
  prev_target * (max_close - min_close) + min_close AS last_value
FROM fr JOIN co USING (ticker) WHERE split = 'test')"""


@register(
    "ar1_predictions",
    with_bars(
        "supplier",
        f"SELECT ticker, date, {sql_round('actual', 2)} AS actual, {sql_round('predicted', 2)} AS predicted, {sql_round('last_value', 2)} AS last_value FROM pr",
        *sql_model_ctes(),
        SQL_AR1_FIT,
        SQL_AR1_PRED,
    ),
)
def q_ar1_predictions(spark, sf):
    """M4, M5, C4: actual vs predicted close on the test part, with the last-value yardstick."""
    return rounded(ar1_predictions(_frame(spark, sf)), {"actual": 2, "predicted": 2, "last_value": 2})


@register(
    "forecast_metrics",
    with_bars(
        "supplier",
        f"""SELECT ticker, count(*) AS n_test,
  {sql_round('avg((predicted - actual) * (predicted - actual))', 2)} AS mse,
  {sql_round('sqrt(avg((predicted - actual) * (predicted - actual)))', 4)} AS rmse,
  {sql_round('avg(abs(predicted - actual))', 4)} AS mae,
  {sql_round('avg((last_value - actual) * (last_value - actual))', 2)} AS mse_last_value,
  {sql_round('sqrt(avg((last_value - actual) * (last_value - actual)))', 4)} AS rmse_last_value,
  {sql_round('avg(abs(last_value - actual))', 4)} AS mae_last_value
FROM pr GROUP BY ticker""",
        *sql_model_ctes(),
        SQL_AR1_FIT,
        SQL_AR1_PRED,
    ),
)
def q_forecast_metrics(spark, sf):
    """MSE, RMSE, MAE per series for AR(1) and for the last-value forecast."""
    m = evaluate(ar1_predictions(_frame(spark, sf)))
    return rounded(m, {"mse": 2, "rmse": 4, "mae": 4, "mse_last_value": 2, "rmse_last_value": 4, "mae_last_value": 4})


def _sql_forecast(business_days: bool, fixture: str = "supplier", target: str = "close") -> str:
    if business_days:
        dates = """(SELECT ticker, d AS date, row_number() OVER (PARTITION BY ticker ORDER BY d) AS step
  FROM (SELECT ticker, unnest(generate_series(last_date + 1, last_date + 67, INTERVAL 1 DAY))::DATE AS d FROM st)
  WHERE dayofweek(d) NOT IN (0, 6))"""
    else:
        dates = "(SELECT ticker, CAST(last_date + CAST(s AS INTEGER) AS DATE) AS date, s AS step FROM st, range(1, 31) r(s))"
    return with_bars(
        fixture,
        f"""SELECT p.ticker, CAST(p.step AS INTEGER) AS step, dt.date, {sql_round(f'p.x * (st.max_{target} - st.min_{target}) + st.min_{target}', 2)} AS predicted_{target}
FROM path p JOIN st USING (ticker) JOIN {dates} dt ON dt.ticker = p.ticker AND dt.step = p.step""",
        *sql_model_ctes(target),
        SQL_AR1_FIT,
        f"""st AS (SELECT fr.ticker, arg_max(label, date) AS x_last, max(date) AS last_date,
  first(min_{target}) AS min_{target}, first(max_{target}) AS max_{target} FROM fr GROUP BY fr.ticker)""",
        """path AS (SELECT * FROM (WITH RECURSIVE it(ticker, step, x) AS (
    SELECT st.ticker, 0, st.x_last FROM st JOIN co USING (ticker) WHERE co.slope IS NOT NULL
    UNION ALL
    SELECT it.ticker, it.step + 1, co.intercept + co.slope * it.x FROM it JOIN co USING (ticker) WHERE it.step < 30)
  SELECT * FROM it WHERE step >= 1))""",
    )


@register("ar1_forecast", _sql_forecast(False))
def q_ar1_forecast(spark, sf):
    """M6, M7, M8: recursive 30-step AR(1) forecast per series, calendar-day dates."""
    return rounded(recursive_forecast(_frame(spark, sf), "close", horizon=30), {"predicted_close": 2})


@register("ar1_forecast_business_days", _sql_forecast(True))
def q_ar1_forecast_business_days(spark, sf):
    """M7 option: the same forecast dated on Monday-Friday only."""
    return rounded(recursive_forecast(_frame(spark, sf), "close", horizon=30, business_days=True), {"predicted_close": 2})


@register("ar1_forecast_blocked", _sql_forecast(False, "lineitem"))
def q_ar1_forecast_blocked(spark, sf):
    """M8 for long series: the modelling frame built per (ticker, year) block with halos and
    per-series aggregates (no window spans a whole series), then the recursive AR(1) forecast —
    over the three return-flag series that each hold a third of the rows."""
    return rounded(recursive_forecast(model_frame_blocked(written(spark, bars_lineitem(spark, sf), "bars"), "close"), "close", horizon=30), {"predicted_close": 2})


def _sql_lag_regression(n: int = N_LAGS) -> list[str]:
    lags = ", ".join(f"lag(close_scaled, {i}) OVER w AS x{i}" for i in range(1, n + 1))
    return [f"lg AS (SELECT ticker, date, {lags} FROM sc WINDOW w AS (PARTITION BY ticker ORDER BY date))", *sql_least_squares(n)]


def sql_elimination(name: str, unknowns: int) -> list[str]:
    """Gauss-Jordan elimination of the list-of-lists ``m`` of the table ``name`` as CTEs; the last, ``name_<unknowns>``, has the
    solution in each row's last cell."""
    out = []
    for k in range(1, unknowns + 1):
        before = name if k == 1 else f"{name}_{k - 1}"
        out.append(
            f"""{name}_{k} AS MATERIALIZED (SELECT * REPLACE (list_transform(m, lambda row, i: CASE WHEN i = {k}
  THEN list_transform(row, lambda v: v / row[{k}]) ELSE list_transform(row, lambda v, j: v - row[{k}] / m[{k}][{k}] * m[{k}][j]) END) AS m) FROM {before})"""
        )
    return out


def sql_least_squares(n: int) -> list[str]:
    """Least squares of the labels on ``x1 .. xn`` of ``lg`` as CTEs: centred normal equations and their
    elimination (``c1`` has the coefficients, ``mn`` the means, ``pd`` the predictions)."""
    xs = range(1, n + 1)
    known = " AND ".join(f"x{i} IS NOT NULL" for i in xs)
    column = lambda j: "y" if j == n + 1 else f"x{j}"
    rows = ", ".join("[" + ", ".join(f"sum((x{i} - m{i}) * ({column(j)} - m{j}))" for j in range(1, n + 2)) + "]" for i in xs)
    slope = " + ".join(f"b{i} * (x{i} - m{i})" for i in xs)
    return [
        f"rw AS MATERIALIZED (SELECT fr.ticker, fr.date, split, label AS y, {', '.join(f'x{i}' for i in xs)} FROM fr JOIN lg USING (ticker, date) WHERE {known})",
        f"mn AS MATERIALIZED (SELECT {', '.join(f'avg({column(j)}) AS m{j}' for j in range(1, n + 2))} FROM rw WHERE split = 'train')",
        f"eq AS (SELECT [{rows}] AS m FROM rw, mn WHERE split = 'train')",
        *sql_elimination("eq", n),
        f"c1 AS MATERIALIZED (SELECT {', '.join(f'm[{i}][{n + 1}] AS b{i}' for i in xs)} FROM eq_{n})",
        f"pd AS (SELECT ticker, date, y, m{n + 1} + {slope} AS p FROM rw, mn, c1 WHERE split = 'test')",
    ]


@register(
    "lag_regression",
    with_bars(
        "supplier",
        f"SELECT ticker, date, {sql_round('y', 9)} AS label, {sql_round('p')} AS predicted FROM pd",
        *sql_model_ctes(),
        *_sql_lag_regression(),
    ),
)
def q_lag_regression(spark, sf):
    """M3 (b): one Spark ML linear regression on 5 lags over the training rows of all series;
    predictions on the test rows."""
    _model, scored = fit_lag_regression(model_frame(bars_supplier(spark, sf), "close", n_lags=N_LAGS))
    return rounded(scored.select("ticker", "date", "label", F.col("prediction").alias("predicted")), {"label": 9, "predicted": 6})


# ================================================================== multiplication


def sql_mix32(x: str) -> str:
    """DuckDB form of ``mix32``."""
    r1 = f"((xor(({x}) >> 16, ({x})) * 73244475) & 4294967295)"
    r2 = f"((xor({r1} >> 16, {r1}) * 73244475) & 4294967295)"
    return f"xor({r2} >> 16, {r2})"


def sql_multiply(fixture: str, copies: int, seed: int = SEED) -> str:
    def fac(slot: int, amp: float) -> str:
        x = f"((w{slot} + CAST(copy_id AS BIGINT) * 2654435761) & 4294967295)"
        u = f"({sql_mix32(x)} / 4294967296.0::DOUBLE)"
        return (
            f"CASE WHEN copy_id = 0 THEN 1.0::DOUBLE ELSE 1.0::DOUBLE + {amp}::DOUBLE * "
            f"(2.0::DOUBLE * {u} - 1.0::DOUBLE) END"
        )

    words = ", ".join(f"CAST(('0x' || substr(h, {8 * k + 1}, 8)) AS BIGINT) AS w{k}" for k in range(5))
    return with_bars(
        fixture,
        f"""SELECT ticker, date, copy_id, open * {fac(0, 0.02)} AS open, high * {fac(1, 0.02)} AS high,
  low * {fac(2, 0.02)} AS low, close * {fac(3, 0.02)} AS close, volume * {fac(4, 0.05)} AS volume FROM rep""",
        f"hx AS (SELECT *, sha256(concat_ws('|', ticker, CAST(date AS VARCHAR), '{seed}')) AS h FROM bars)",
        f"wd AS (SELECT *, {words} FROM hx)",
        f"rep AS (SELECT wd.*, CAST(c.range AS INTEGER) AS copy_id FROM wd, range(0, {copies + 1}) c)",
    )


def sql_copy_sums(rows: str) -> str:
    """Exact sums of every value of each copy, in ten thousandths."""
    sums = ", ".join(f"CAST(sum(CAST(floor({c} * 10000) AS BIGINT)) AS BIGINT) AS {c}" for c in ("open", "high", "low", "close", "volume"))
    return f"SELECT ticker, copy_id, count(*) AS n, {sums} FROM ({rows}) GROUP BY ticker, copy_id"


def copy_sums(df: DataFrame) -> DataFrame:
    sums = [F.sum(F.floor(F.col(c) * 10000).cast("bigint")).alias(c) for c in ("open", "high", "low", "close", "volume")]
    return df.groupBy("ticker", F.col("copy_id").cast("int").alias("copy_id")).agg(F.count(F.lit(1)).alias("n"), *sums)


@register("multiply_bars", sql_copy_sums(sql_multiply("lineitem", COPIES_LARGE)))
def q_multiply_bars(spark, sf):
    """Original (copy 0) plus 500 copies with reproducible ±2 % price and ±5 % volume noise;
    every generated value enters the exact sums of its copy."""
    return copy_sums(multiply_bars(bars_lineitem(spark, sf), COPIES_LARGE, SEED))


@register(
    "yearly_of_copies",
    "WITH mb AS ("
    + sql_multiply("lineitem", COPIES_LARGE)
    + f"""),
clean AS (SELECT * FROM mb WHERE {SQL_CLOSE_VOLUME}),
enr AS ({sql_enrich('clean', returns=False)})
SELECT year, ticker, {sql_round('avg(close)', 4)} AS avg_close, {sql_exact_mean('intra_day_volatility')} AS avg_volatility FROM enr GROUP BY year, ticker""",
)
def q_yearly_of_copies(spark, sf):
    """Large-data plan in one lineage at the reference's 500 copies: multiply → close/volume clean →
    enrich → yearly means over all copies (every generated row feeds the means)."""
    mb = multiply_bars(bars_lineitem(spark, sf), COPIES_LARGE, SEED)
    y = yearly_summary(enrich(filter_outliers(mb, "close_volume"), returns=False), exact=("avg_volatility",))
    return rounded(y, {"avg_close": 4})


# ================================================================== sources, sinks, round trips


@register("json_array_roundtrip", SQL_BARS["lineitem"])
def q_json_array_roundtrip(spark, sf):
    """One JSON array per ticker, read back as multi-line JSON, ticker from the path."""
    path = scratch_path(spark, "json-arrays")
    write_json_arrays(bars_lineitem(spark, sf), path)
    return read_bars_json(spark, path, multiline=True).select(*BAR_COLS)


@register("landing_roundtrip", sql_copy_sums(sql_multiply("lineitem", COPIES_LARGE)))
def q_landing_roundtrip(spark, sf):
    """Every copy of every ticker landed as line JSON in one write, merged back in one scan."""
    path = scratch_path(spark, "landing")
    write_line_json(multiply_bars(bars_lineitem(spark, sf), COPIES_LARGE, SEED), path)
    return copy_sums(read_bars_json(spark, path))


SQL_ODD_TICKER = "CASE ticker WHEN 'A' THEN '^G+ SPC' WHEN 'N' THEN 'EUR/USD=X%5E' END"


@register(
    "odd_ticker_roundtrip",
    with_bars("lineitem", f"SELECT {SQL_ODD_TICKER} AS ticker, date, open, high, low, close, volume FROM bars"),
)
def q_odd_ticker_roundtrip(spark, sf):
    """Tickers with reserved characters, and NULL, survive the partitioned line-JSON landing."""
    path = scratch_path(spark, "odd-tickers")
    odd = bars_lineitem(spark, sf).withColumn("ticker", F.expr(SQL_ODD_TICKER))
    write_line_json(odd, path, partition_by=["ticker"])
    return read_bars_json(spark, path).select(*BAR_COLS)


@register("wrapped_json_roundtrip", SQL_BARS["events"])
def q_wrapped_json_roundtrip(spark, sf):
    """Series written as a JSON-array string inside a JSON record, unwrapped with from_json + explode."""
    path = scratch_path(spark, "wrapped")
    write_wrapped_json(bars_events(spark, sf), path)
    return read_wrapped_json(spark, path).select(*BAR_COLS)


@register("text_array_roundtrip", SQL_BARS["events"])
def q_text_array_roundtrip(spark, sf):
    """K4: one whole JSON array per text line, read back as text and unwrapped."""
    path = scratch_path(spark, "text")
    write_text(to_json_records(bars_events(spark, sf)), path, "json", partition_by=["ticker"])
    return read_wrapped_json(spark, path, text=True).select(*BAR_COLS)


@register("parquet_roundtrip", with_bars("supplier", "SELECT * FROM enr", f"clean AS (SELECT * FROM bars WHERE {SQL_STRICT})", f"enr AS ({sql_enrich('clean')})"))
def q_parquet_roundtrip(spark, sf):
    """Enriched table written as Parquet partitioned by year and scanned back."""
    path = scratch_path(spark, "parquet")
    write_parquet(_clean_enriched(spark, sf, "supplier"), path, partition_by=["year"])
    return read_bars_parquet(spark, path)


@register(
    "union_by_name",
    f"""SELECT * FROM ({SQL_BARS['lineitem']}) UNION ALL BY NAME
SELECT volume, close, low, high, open, date, ticker FROM ({SQL_BARS['events']}) UNION ALL BY NAME
SELECT *, 'supplier' AS fixture FROM ({SQL_BARS['supplier']})""",
)
def q_union_by_name(spark, sf):
    """By-name union of tables with different column orders and an extra column."""
    ev = bars_events(spark, sf)
    frames = [
        bars_lineitem(spark, sf),
        ev.select(*reversed(ev.columns)),
        bars_supplier(spark, sf).withColumn("fixture", F.lit("supplier")),
    ]
    return union_by_name(frames)


# ================================================================== whole jobs


@register("landing_to_yearly", _sql_yearly("lineitem"))
def q_landing_to_yearly(spark, sf):
    """Small job end to end: JSON-array landing → profile → strict clean → enrich → Parquet → yearly means."""
    base = scratch_path(spark, "small-job")
    write_json_arrays(bars_lineitem(spark, sf), f"{base}/landing")
    res = jobs.landing_to_yearly(spark, f"{base}/landing", f"{base}/out", exact=True)
    return res.yearly


def series_tickers(spark, sf: str) -> DataFrame:
    """The tickers that the lineitem bars should hold: every return flag of the table."""
    return spark.read.parquet(f"{sf}/lineitem.parquet").select(F.col("l_returnflag").alias("ticker")).distinct()


@register(
    "copies_to_yearly",
    "WITH mb AS ("
    + sql_multiply("lineitem", COPIES_LARGE)
    + f"""),
clean AS (SELECT * FROM mb WHERE {SQL_CLOSE_VOLUME}),
enr AS ({sql_enrich('clean', returns=False)})
SELECT year, ticker, {sql_round('avg(close)', 4)} AS avg_close, {sql_exact_mean('intra_day_volatility')} AS avg_volatility FROM enr GROUP BY year, ticker""",
)
def q_copies_to_yearly(spark, sf):
    """Large job end to end: land noisy copies as line JSON → merged scan → clean → enrich → Parquet → yearly means."""
    base = scratch_path(spark, "large-job")
    jobs.land_copies(bars_lineitem(spark, sf), f"{base}/landing", copies=COPIES_LARGE, seed=SEED)
    res = jobs.copies_to_yearly(spark, f"{base}/landing", f"{base}/out", series_tickers(spark, sf), exact=("avg_volatility",))
    return rounded(res.yearly, {"avg_close": 4})


# ================================================================== streaming


@register("stream_yearly", _sql_yearly("lineitem"))
def q_stream_yearly(spark, sf):
    """The small plan under Structured Streaming: line-JSON landing → file stream → clean → enrich,
    run with an availableNow trigger; the yearly means are a batch aggregation of the whole clean table."""
    base = scratch_path(spark, "stream")
    write_line_json(bars_lineitem(spark, sf), f"{base}/landing", partition_by=["ticker"])
    return run_available(spark, f"{base}/landing", f"{base}/out")
