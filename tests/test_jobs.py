from pyspark.sql import functions as F

from barframe.plans.jobs import copies_to_yearly, land_copies, landing_to_yearly
from barframe.sources.writers import write_json_arrays
from tests.conftest import bars

ROWS = [
    ("AAPL", "2023-01-02", 100.0, 110.0, 90.0, 105.0, 1000.0),
    ("AAPL", "2023-01-03", 101.0, 111.0, 91.0, 106.0, 2000.0),
    ("MSFT", "2023-01-02", 50.0, 55.0, 45.0, -1.0, 500.0),  # rejected by both profiles
]


def test_large_job_with_coverage(spark, tmp_dir):
    land_copies(bars(spark, ROWS), f"{tmp_dir}/landing", copies=3, seed=5)
    expected = spark.createDataFrame([("AAPL",), ("MSFT",), ("NFLX",)], "ticker string")
    res = copies_to_yearly(spark, f"{tmp_dir}/landing", f"{tmp_dir}/out", expected)
    cov = {r.ticker: (r.n_bars, r.n_clean, r.status) for r in res.coverage.collect()}
    assert cov == {"AAPL": (8, 8, "ok"), "MSFT": (4, 0, "no clean data"), "NFLX": (0, 0, "no data")}
    assert res.clean.count() == 8 and set(res.clean.columns) >= {"year", "intra_day_volatility"}
    assert [r.ticker for r in res.yearly.collect()] == ["AAPL"]
    assert spark.read.parquet(f"{tmp_dir}/out/yearly").count() == 1
    assert {(r.ticker, r.status) for r in res.files.collect()} == {("AAPL", "ok"), ("MSFT", "ok")}


def test_small_job_profile_and_yearly(spark, tmp_dir):
    write_json_arrays(bars(spark, ROWS), f"{tmp_dir}/landing")
    res = landing_to_yearly(spark, f"{tmp_dir}/landing", f"{tmp_dir}/out", exact=True)
    prof = {(r.stage, r.field): r["count"] for r in res.profile.collect()}
    assert prof[("before", "close")] == 3 and prof[("after", "close")] == 2
    y = res.yearly.first()
    assert (y.year, y.ticker, y.avg_close) == (2023, "AAPL", 105.5)
    assert res.clean.filter(F.col("ticker") == "MSFT").count() == 0


def test_forecast_job_in_blocks_equals_the_whole_series(spark):
    import datetime as dt

    from barframe.operators.modeling import forecast
    from barframe.plans.jobs import forecast_all

    rows = []
    for t, n in (("A", 420), ("B", 90)):
        for i in range(n):
            c = 50.0 + (i * 37 % 11) + i / 20
            rows.append((t, (dt.date(2022, 6, 1) + dt.timedelta(days=i)).isoformat(), c - 1, c + 2, c - 2, c, 100.0 + i % 7))
    src = bars(spark, rows)
    key = lambda df: sorted((r.ticker, r.step, r.date, round(r.predicted_close, 9)) for r in df.collect())
    whole = key(forecast(src, horizon=5))
    assert len(whole) == 10 and key(forecast(src, horizon=5, block="month")) == whole
    assert key(forecast_all(src, horizon=5, block="year").forecast) == whole
