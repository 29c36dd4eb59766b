"""More queries of the catalog: dirty input, landings and their files, whole jobs, the regression on
all features. Importing the module registers them beside those of ``catalog``.

The dirty bars are derived from the lineitem bars by the day of the month, so that every fault
occurs in every series and grows with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barframe.functions.expressions import to_bar_timestamp
from barframe.operators.aggregate import describe_before_after
from barframe.operators.clean import filter_outliers, rejected_rows
from barframe.operators.indicators import FEATURES
from barframe.operators.modeling import SCALED_FEATURES, feature_forecast, fit_feature_regression, model_frame
from barframe.operators.multiply import add_noise, multiply_bars, replicate
from barframe.plans import jobs
from barframe.plans.catalog import (
    BAR_COLS,
    COPIES_LARGE,
    SEED,
    SQL_BARS,
    SQL_CLOSE_VOLUME,
    SQL_STRICT,
    _sql_describe,
    _sql_forecast,
    _sql_reason,
    copy_sums,
    register,
    rounded,
    sql_copy_sums,
    sql_least_squares,
    sql_model_ctes,
    sql_multiply,
    sql_round,
    with_bars,
)
from barframe.plans.workspace import cut_lineage, scratch_path
from barframe.schema import flatten_columns, has_columns, require_columns
from barframe.sources.fixtures import bars_events, bars_lineitem, bars_supplier
from barframe.sources.readers import file_report, read_bars_json, read_bars_parquet
from barframe.sources.writers import landed_records, write_json_arrays, write_line_json, write_parquet

# ================================================================== dirty input

#: What is wrong on which day of the month: (day, column, value in SQL).
FAULTS = [
    (1, "volume", "CAST('NaN' AS DOUBLE)"),
    (2, "open", "CAST('NaN' AS DOUBLE)"),
    (3, "close", "CAST(1e15 AS DOUBLE)"),
    (4, "close", "CAST(NULL AS DOUBLE)"),
    (5, "volume", "CAST(-1 AS DOUBLE)"),
    (6, "date", "CAST(NULL AS DATE)"),
]


def _faulty(column: str) -> str:
    cases = " ".join(f"WHEN day(date) = {d} THEN {v}" for d, c, v in FAULTS if c == column)
    return f"CASE {cases} ELSE {column} END AS {column}" if cases else column


DIRTY_COLUMNS = [_faulty(c) for c in BAR_COLS]
SQL_DIRTY = f"db AS (SELECT {', '.join(DIRTY_COLUMNS)} FROM bars)"
SQL_COMPLETE = f"{SQL_STRICT} AND NOT isnan(volume) AND date IS NOT NULL"


def dirty_bars(spark, sf: str) -> DataFrame:
    return bars_lineitem(spark, sf).selectExpr(*DIRTY_COLUMNS)


@register("clean_complete", with_bars("lineitem", f"SELECT * FROM db WHERE {SQL_COMPLETE}", SQL_DIRTY))
def q_clean_complete(spark, sf):
    """F1 over dirty bars, with a date and a volume that is a number required as well."""
    return filter_outliers(dirty_bars(spark, sf), "strict_complete")


@register(
    "rejects_dirty",
    with_bars(
        "lineitem",
        f"""SELECT ticker, date, high, low, concat_ws(',', CASE WHEN date IS NULL THEN 'date:null' END,
  {', '.join(_sql_reason(c) for c in ('open', 'high', 'low', 'close'))},
  CASE WHEN volume IS NULL THEN 'volume:null' WHEN volume < 0 THEN 'volume:below_min' WHEN isnan(volume) THEN 'volume:nan' END) AS reasons
FROM db WHERE NOT coalesce({SQL_COMPLETE}, false)""",
        SQL_DIRTY,
    ),
)
def q_rejects_dirty(spark, sf):
    """F3 over dirty bars: every kind of reason occurs."""
    return rejected_rows(dirty_bars(spark, sf), "strict_complete").select("ticker", "date", "high", "low", "reasons")


def _sql_dirty_profile() -> str:
    parts = []
    for stage, keep in (("before", "true"), ("after", f"coalesce({SQL_COMPLETE}, false)")):
        for c in ("open", "high", "low", "close", "volume"):
            finite = f"CASE WHEN {keep} AND isfinite({c}) THEN {c} END"
            parts.append(
                f"""SELECT '{stage}' AS stage, '{c}' AS field, count(CASE WHEN {keep} THEN {c} END) AS count,
  {sql_round(f'CAST(sum(CAST({finite} AS DECIMAL(28,4))) AS DOUBLE) / count({finite})', 4)} AS mean,
  {sql_round(f'stddev_samp(CASE WHEN abs({finite}) < 1e9 THEN {finite} END)', 4)} AS stddev, min({finite}) AS min, max({finite}) AS max FROM db"""
            )
    return "\nUNION ALL\n".join(parts)


@register("describe_dirty", with_bars("lineitem", _sql_dirty_profile(), SQL_DIRTY))
def q_describe_dirty(spark, sf):
    """A5 over dirty bars, where the exact means leave NaN out. NaN sorts above all numbers, so a maximum
    may be NaN; the finite extremes come from the same profile of the finite values, and the deviation from that of
    the plausible ones (among closes of 1e15 a sum of squares keeps no digits of the others)."""
    bars = dirty_bars(spark, sf)
    profile = describe_before_after(bars, "strict_complete", exact=True).select("stage", "field", "count", "mean")
    finite = bars.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("open", "volume")})
    extremes = describe_before_after(finite, "strict_complete", exact=True).select("stage", "field", "min", "max")
    plausible = finite.withColumn("close", F.when(F.abs("close") < 1e9, F.col("close")))
    spread = describe_before_after(plausible, "strict_complete", exact=True).select("stage", "field", "stddev")
    return rounded(profile.join(extremes, ["stage", "field"]).join(spread, ["stage", "field"]), {"mean": 4, "stddev": 4})


# ================================================================== landings and their files


@register("merged_roundtrip", sql_copy_sums(sql_multiply("events", COPIES_LARGE)))
def q_merged_roundtrip(spark, sf):
    """Copies landed in a folder each, merged into one landing by ticker, read back with their copy."""
    path = scratch_path(spark, "merged")
    write_line_json(multiply_bars(bars_events(spark, sf), COPIES_LARGE, SEED), f"{path}/copies", partition_by=["ticker", "copy_id"])
    write_line_json(read_bars_json(spark, f"{path}/copies"), f"{path}/merged")
    return copy_sums(read_bars_json(spark, f"{path}/merged"))


@register(
    "file_report_faulty",
    with_bars(
        "lineitem",
        """SELECT ticker, count(*) AS n_records, count(*) FILTER (WHERE day(date) = 13) AS n_malformed,
  count(*) FILTER (WHERE day(date) = 14) AS n_no_date, count(*) FILTER (WHERE day(date) = 15) AS n_incomplete, 'faulty' AS status
FROM bars GROUP BY ticker""",
    ),
)
def q_file_report_faulty(spark, sf):
    """A landing of which some records are cut off, some have no date and some no volume."""
    path = scratch_path(spark, "faulty")
    bars = bars_lineitem(spark, sf)
    day = F.dayofmonth("date")
    records = landed_records(bars.withColumn("volume", F.when(day != 15, F.col("volume")))).withColumn("day", F.dayofmonth(F.to_date(F.substring("Date", 1, 10))))
    fields = F.struct(F.when(F.col("day") == 14, "no date").otherwise(F.col("Date")).alias("Date"), "Open", "High", "Low", "Close", "Volume")
    text = F.to_json(fields)
    cut = F.when(F.col("day") == 13, F.expr("substring(line, 1, length(line) - 5)")).otherwise(F.col("line"))
    records.withColumn("line", text).select("ticker", cut.alias("value")).write.partitionBy("ticker").text(path)
    counts = ["n_records", "n_malformed", "n_no_date", "n_incomplete"]
    return file_report(spark, path).groupBy("ticker").agg(*[F.sum(c).alias(c) for c in counts], F.max("status").alias("status"))


@register("landed_sources", with_bars("supplier", "SELECT ticker, 'ticker=' || ticker AS folder, count(*) AS n_bars FROM bars GROUP BY ticker"))
def q_landed_sources(spark, sf):
    """Every bar with the folder that it was read from."""
    path = scratch_path(spark, "sources")
    write_line_json(bars_supplier(spark, sf), path)
    back = read_bars_json(spark, path).withColumn("folder", F.element_at(F.split("source", "/"), -2))
    return back.groupBy("ticker", "folder").agg(F.count(F.lit(1)).alias("n_bars"))


@register(
    "bar_timestamps",
    with_bars("supplier", "SELECT ticker, date, CASE WHEN day(date) <> 31 THEN strftime(date, '%Y-%m-%d %H:%M:%S') END AS at FROM bars"),
)
def q_bar_timestamps(spark, sf):
    """P5: ISO texts as timestamps; an unreadable text gives NULL."""
    text = F.when(F.dayofmonth("date") == 31, "no date").otherwise(F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss.SSS"))
    return bars_supplier(spark, sf).select("ticker", "date", F.date_format(to_bar_timestamp(text), "yyyy-MM-dd HH:mm:ss").alias("at"))


@register("flattened_bars", SQL_BARS["events"])
def q_flattened_bars(spark, sf):
    """Two-level headers flattened to their first part, then the column checks."""
    headers = [(c, "X") for c in BAR_COLS]
    two_level = bars_events(spark, sf).select(*BAR_COLS).toDF(*[str(h) for h in headers])
    flat = flatten_columns(two_level, headers)
    if has_columns(two_level, BAR_COLS):
        raise ValueError("two-level headers must not pass for plain ones")
    return require_columns(flat, BAR_COLS)


@register("parquet_once", SQL_BARS["supplier"])
def q_parquet_once(spark, sf):
    """K2: a Parquet write that fails if the table exists, into a new folder, read back."""
    path = scratch_path(spark, "once")
    bars = bars_supplier(spark, sf)
    write_parquet(bars, path, mode="errorifexists")
    return read_bars_parquet(spark, path, bars.schema)


def _exact_sums(src: str, columns: tuple[str, ...]) -> str:
    sums = ", ".join(f"CAST(sum(CAST(floor({c} * 10000) AS BIGINT)) AS BIGINT) AS {c}" for c in columns)
    return f"SELECT ticker, copy_id, count(*) AS n, {sums} FROM ({src}) GROUP BY ticker, copy_id"


@register("noise_partial", _exact_sums(sql_multiply("events", COPIES_LARGE), ("close", "volume")))
def q_noise_partial(spark, sf):
    """Noise on a frame without open, high and low."""
    copies = add_noise(replicate(bars_events(spark, sf).select("ticker", "date", "close", "volume"), COPIES_LARGE), SEED)
    sums = [F.sum(F.floor(F.col(c) * 10000).cast("bigint")).alias(c) for c in ("close", "volume")]
    return copies.groupBy("ticker", "copy_id").agg(F.count(F.lit(1)).alias("n"), *sums)


# ================================================================== whole jobs


@register(
    "job_profile",
    with_bars(
        "lineitem",
        _sql_describe("bars", "before", None) + "\nUNION ALL\n" + _sql_describe("bars", "after", f"coalesce({SQL_STRICT}, false)"),
    ),
)
def q_job_profile(spark, sf):
    """A5 as a product of the small job."""
    base = scratch_path(spark, "small-job")
    write_json_arrays(bars_lineitem(spark, sf), f"{base}/landing")
    return rounded(jobs.landing_to_yearly(spark, f"{base}/landing", f"{base}/out", exact=True).profile, {"stddev": 6})


@register(
    "job_coverage",
    "WITH mb AS ("
    + sql_multiply("events", COPIES_LARGE)
    + f"""),
e AS (SELECT event_type AS ticker FROM events UNION SELECT l_returnflag FROM lineitem),
c AS (SELECT ticker, count(*) AS n_bars, count(*) FILTER (WHERE coalesce({SQL_CLOSE_VOLUME}, false)) AS n_clean FROM mb GROUP BY ticker)
SELECT ticker, coalesce(n_bars, 0) AS n_bars, coalesce(n_clean, 0) AS n_clean,
  CASE WHEN coalesce(n_bars, 0) = 0 THEN 'no data' WHEN n_clean = 0 THEN 'no clean data' ELSE 'ok' END AS status
FROM e LEFT JOIN c USING (ticker)""",
)
def q_job_coverage(spark, sf):
    """V1 as a product of the large job, over a list that holds more than was landed."""
    base = scratch_path(spark, "large-job")
    jobs.land_copies(bars_events(spark, sf), f"{base}/landing", copies=COPIES_LARGE, seed=SEED)
    landed = spark.read.parquet(f"{sf}/events.parquet").select(F.col("event_type").alias("ticker"))
    others = spark.read.parquet(f"{sf}/lineitem.parquet").select(F.col("l_returnflag").alias("ticker"))
    return jobs.copies_to_yearly(spark, f"{base}/landing", f"{base}/out", landed.union(others).distinct()).coverage


@register("forecast_volume", _sql_forecast(False, target="volume"))
def q_forecast_volume(spark, sf):
    """The forecast job for another target than the close."""
    return rounded(jobs.forecast_all(bars_supplier(spark, sf), "volume").forecast, {"predicted_volume": 2})


# ================================================================== modelling


@register(
    "train_fitted_scaling",
    with_bars(
        "supplier",
        f"SELECT ticker, date, {sql_round('close_scaled', 9)} AS close_scaled, min_close, max_close, split FROM fr",
        *sql_model_ctes(bounds_where=" FILTER (WHERE place < cutoff)"),
    ),
)
def q_train_fitted_scaling(spark, sf):
    """M1 with bounds from the rows before the first test label only."""
    frame = model_frame(bars_supplier(spark, sf), "close", fit_on="train")
    return rounded(frame.select("ticker", "date", "close_scaled", "min_close", "max_close", "split"), {"close_scaled": 9})


_N = len(FEATURES)
_LAGGED = ", ".join(f"lag({c}) OVER w AS x{i}" for i, c in enumerate(SCALED_FEATURES, 1))
SQL_FEATURE_FIT = [f"lg AS (SELECT ticker, date, {_LAGGED} FROM sc WINDOW w AS (PARTITION BY ticker ORDER BY date))", *sql_least_squares(_N)]


@register(
    "feature_regression",
    with_bars("supplier", f"SELECT ticker, date, {sql_round('y', 9)} AS label, {sql_round('p')} AS predicted FROM pd", *sql_model_ctes(), *SQL_FEATURE_FIT),
)
def q_feature_regression(spark, sf):
    """M3, M4 on all twelve features of the row before."""
    _model, scored = fit_feature_regression(model_frame(bars_supplier(spark, sf), "close", previous=SCALED_FEATURES))
    return rounded(scored.select("ticker", "date", "label", F.col("prediction").alias("predicted")), {"label": 9, "predicted": 6})


_OWN = FEATURES.index("close") + 1


@register(
    "feature_forecast",
    with_bars(
        "supplier",
        f"""SELECT ticker, CAST(step AS INTEGER) AS step, CAST(last_date + CAST(step AS INTEGER) AS DATE) AS date,
  {sql_round('x * (max_close - min_close) + min_close', 2)} AS predicted_close FROM path JOIN st USING (ticker)""",
        *sql_model_ctes(),
        *SQL_FEATURE_FIT,
        f"cf AS (SELECT m{_N + 1} - ({' + '.join(f'b{i} * m{i}' for i in range(1, _N + 1))}) AS base, * FROM c1, mn)",
        f"""st AS (SELECT ticker, max(date) AS last_date, first(min_close) AS min_close, first(max_close) AS max_close,
  {', '.join(f'arg_max({c}, date) AS f{i}' for i, c in enumerate(SCALED_FEATURES, 1))} FROM fr GROUP BY ticker)""",
        f"s1 AS (SELECT ticker, base + {' + '.join(f'b{i} * f{i}' for i in range(1, _N + 1))} AS x, base, b{_OWN} AS own FROM st, cf)",
        """path AS (SELECT * FROM (WITH RECURSIVE it(ticker, step, x, base, own) AS (
    SELECT ticker, 1, x, base, own FROM s1
    UNION ALL
    SELECT ticker, step + 1, base + own * x, base, own FROM it WHERE step < 30)
  SELECT ticker, step, x FROM it))""",
    ),
)
def q_feature_forecast(spark, sf):
    """M6, M7 on all features: after the first step the other features are scaled 0."""
    frame = model_frame(bars_supplier(spark, sf), "close", previous=SCALED_FEATURES)
    used = ["ticker", "date", "split", "label", "min_close", "max_close", *SCALED_FEATURES, *(f"prev_{c}" for c in SCALED_FEATURES)]
    frame = cut_lineage(frame.select(*used))
    model, _scored = fit_feature_regression(frame, written=True)
    return rounded(feature_forecast(frame, model, "close"), {"predicted_close": 2})
