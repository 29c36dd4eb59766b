from decimal import Decimal

import pytest

from barframe.operators.aggregate import describe_bars, describe_before_after, yearly_summary
from barframe.operators.clean import (
    coverage_report,
    drop_incomplete,
    filter_outliers,
    missing_tickers,
    rejected_rows,
    restrict_dates,
    select_series,
)
from barframe.operators.enrich import add_volatility, enrich, tag_ticker
from barframe.schema import MissingColumnsError, flatten_columns, has_columns, require_columns, schema_report
from tests.conftest import bars


def test_zero_open_kept_by_close_volume_only(spark):
    df = bars(spark, [("A", "2024-01-02", 0.0, 10.0, 5.0, 8.0, 100.0)])
    assert filter_outliers(df, "strict").count() == 0
    kept = filter_outliers(df, "close_volume")
    assert kept.count() == 1
    row = enrich(kept).first()
    assert row.daily_return is None and row.intra_day_volatility is None


def test_null_close_dropped_and_listed(spark):
    df = bars(spark, [("A", "2024-01-02", 1.0, 2.0, 0.5, None, 10.0)])
    assert filter_outliers(df, "strict").count() == 0
    assert filter_outliers(df, "close_volume").count() == 0
    assert rejected_rows(df).first().reasons == "close:null"


def test_bounds(spark):
    rows = [("A", f"2024-01-0{i + 1}", c, c, c, c, 1.0) for i, c in enumerate([0.0, 100000.0, 99999.99, 0.01])]
    kept = sorted(r.close for r in filter_outliers(bars(spark, rows), "strict").collect())
    assert kept == [0.01, 99999.99]


def test_volume_rules(spark):
    df = bars(spark, [("A", "2024-01-02", 1.0, 1.0, 1.0, 1.0, -1.0), ("A", "2024-01-03", 1.0, 1.0, 1.0, 1.0, 0.0)])
    kept = filter_outliers(df, "strict").collect()
    assert [r.volume for r in kept] == [0.0]
    assert rejected_rows(df).first().reasons == "volume:below_min"


def test_clean_plus_rejected_is_input(spark):
    rows = [
        ("A", "2024-01-02", 1.0, 2.0, 0.5, 1.5, 10.0),
        ("A", "2024-01-03", -1.0, 2.0, 0.5, 1.5, 10.0),
        ("A", "2024-01-04", 1.0, 200000.0, 0.5, 1.5, 10.0),
        ("B", "2024-01-02", None, 2.0, 0.5, 1.5, None),
    ]
    df = bars(spark, rows)
    assert filter_outliers(df).count() + rejected_rows(df).count() == df.count()
    reasons = {r.date.isoformat(): r.reasons for r in rejected_rows(df).collect() if r.ticker == "A"}
    assert reasons == {"2024-01-03": "open:out_of_range", "2024-01-04": "high:out_of_range"}


def test_enrich_calendar_and_rounding(spark):
    df = bars(spark, [("A", "2000-01-02", 100.0, 110.0, 95.0, 105.0, 1.0)])  # a Sunday
    r = enrich(df).first()
    assert (r.year, r.month, r.day_of_week) == (2000, 1, 1)
    assert r.daily_return == 5.0 and r.intra_day_volatility == 15.0
    assert "daily_return" not in enrich(df, returns=False).columns
    v = add_volatility(df).first()
    assert v.volatility == pytest.approx(0.15) and v.volatility_pct == pytest.approx(15.0)
    assert tag_ticker(df.drop("ticker"), "XYZ").first().ticker == "XYZ"


def test_date_range_and_selection(spark):
    rows = [("A", d, 1.0, 1.0, 1.0, 1.0, 1.0) for d in ("1999-12-31", "2000-01-01", "2023-12-31", "2024-01-01")]
    df = bars(spark, rows)
    got = [r.date.isoformat() for r in restrict_dates(df, "2000-01-01", "2024-01-01").orderBy("date").collect()]
    assert got == ["2000-01-01", "2023-12-31"]
    assert select_series(enrich(df), ticker="A", year=2000).count() == 1


def test_coverage_lists_missing(spark):
    expected = spark.createDataFrame([("A",), ("B",), ("C",)], "ticker string")
    df = bars(spark, [("A", "2024-01-02", 1.0, 1.0, 1.0, 1.0, 1.0), ("C", "2024-01-02", -1.0, 1.0, 1.0, 1.0, 1.0)])
    assert [r.ticker for r in missing_tickers(expected, df).collect()] == ["B"]
    status = {r.ticker: (r.n_bars, r.n_clean, r.status) for r in coverage_report(expected, df).collect()}
    assert status == {"A": (1, 1, "ok"), "B": (0, 0, "no data"), "C": (1, 0, "no clean data")}


def test_dropna_removes_null_and_nan(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0), (float("nan"), 1.0)], "a double, b double")
    assert drop_incomplete(df).count() == 1


def test_yearly_exact_equals_plain_mean(spark):
    rows = [("A", f"2024-01-{d:02d}", 1.0, 1.0, 1.0, c, 1.0) for d, c in zip(range(1, 5), [10.01, 10.02, 10.03, 10.05])]
    df = enrich(bars(spark, rows))
    exact = yearly_summary(df, exact=True).first()
    plain = yearly_summary(df).first()
    assert exact.avg_close == pytest.approx(plain.avg_close)
    assert exact.avg_close == float(sum(Decimal(x) for x in ("10.01", "10.02", "10.03", "10.05"))) / 4


def test_describe_matches_spark_describe(spark):
    rows = [("A", f"2024-01-0{i}", float(i), float(i + 1), i - 0.5, float(2 * i), float(10 * i)) for i in range(1, 6)]
    df = bars(spark, rows)
    typed = {r.field: r for r in describe_bars(df).collect()}
    ref = {r.summary: r for r in df.describe(["open", "high", "low", "close", "volume"]).collect()}
    for c in ["open", "high", "low", "close", "volume"]:
        assert typed[c]["count"] == int(ref["count"][c])
        assert typed[c]["mean"] == pytest.approx(float(ref["mean"][c]))
        assert typed[c]["stddev"] == pytest.approx(float(ref["stddev"][c]))
        assert typed[c]["min"] == float(ref["min"][c]) and typed[c]["max"] == float(ref["max"][c])
    ba = {(r.stage, r.field): r["count"] for r in describe_before_after(df.union(bars(spark, [("A", "2024-02-01", -1.0, 1.0, 1.0, 1.0, 1.0)]))).collect()}
    assert ba[("before", "open")] == 6 and ba[("after", "open")] == 5


def test_column_checks(spark):
    df = bars(spark, [("A", "2024-01-02", 1.0, 1.0, 1.0, 1.0, 1.0)])
    assert has_columns(df, ["Close", "date"]) and not has_columns(df, ["Adj Close"])
    assert require_columns(df, ["close"]) is df
    with pytest.raises(MissingColumnsError, match="Adj Close"):
        require_columns(df, ["close", "Adj Close"])
    flat = flatten_columns(df.select("date", "close"), [("Date", ""), ("Close", "AAPL")])
    assert flat.columns == ["Date", "Close"]
    assert ("close", "double", True) in schema_report(df)


def test_enrich_is_one_projection(spark):
    df = bars(spark, [("A", "2024-01-02", 1.0, 1.0, 1.0, 1.0, 1.0)])
    plan = enrich(filter_outliers(df))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") == 1


def test_complete_profile_rejects_missing_dates_and_nan_volumes(spark):
    from pyspark.sql import functions as F

    from barframe.operators.clean import filter_outliers, rejected_rows

    base = bars(spark, [("A", f"2024-01-0{d}", 1.0, 2.0, 0.5, 1.5, 10.0) for d in (1, 2, 3)])
    day = F.dayofmonth("date")
    dirty = base.withColumns({"volume": F.when(day == 2, F.lit(float("nan"))).otherwise(F.col("volume")), "date": F.when(day != 3, F.col("date"))})
    assert filter_outliers(dirty, "strict").count() == 3
    assert filter_outliers(dirty, "strict_complete").count() == 1
    assert sorted(r.reasons for r in rejected_rows(dirty, "strict_complete").collect()) == ["date:null", "volume:nan"]
