from barframe.operators.aggregate import yearly_summary
from barframe.operators.clean import filter_outliers
from barframe.operators.enrich import enrich
from barframe.sources.writers import write_line_json
from barframe.streaming.ingest import clean_enriched_stream, read_yearly, start_yearly_sink, stream_landed_bars, yearly_stream
from tests.conftest import bars

ROWS_1 = [
    ("AAPL", "2023-01-02", 100.0, 110.0, 90.0, 105.0, 1000.0),
    ("AAPL", "2023-01-03", 101.0, 111.0, 91.0, 106.0, 2000.0),
    ("MSFT", "2023-01-02", 50.0, 55.0, 45.0, 52.0, 500.0),
]
ROWS_2 = [
    ("AAPL", "2024-01-02", 120.0, 125.0, 118.0, 121.0, 900.0),
    ("MSFT", "2023-01-03", 51.0, 56.0, 46.0, -1.0, 400.0),  # rejected by the strict profile
    ("MSFT", "2024-01-03", 60.0, 66.0, 58.0, 65.0, 300.0),
]


def _sorted(df):
    return sorted(tuple(r) for r in df.select("year", "ticker", "avg_close", "avg_volatility").collect())


def test_incremental_stream_equals_batch(spark, tmp_dir):
    landing, out, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/yearly", f"{tmp_dir}/ckpt"
    write_line_json(bars(spark, ROWS_1), f"{landing}/batch=1", partition_by=["ticker"])

    def run():
        stream = yearly_stream(clean_enriched_stream(stream_landed_bars(spark, landing)))
        q = start_yearly_sink(stream, out, ckpt)
        q.awaitTermination()
        return read_yearly(spark, out)

    first = run()
    assert _sorted(first) == _sorted(yearly_summary(enrich(filter_outliers(bars(spark, ROWS_1))), exact=True))
    write_line_json(bars(spark, ROWS_2), f"{landing}/batch=2", partition_by=["ticker"])
    second = run()  # same checkpoint: only the new files are read, state carries the first batch
    expected = yearly_summary(enrich(filter_outliers(bars(spark, ROWS_1 + ROWS_2))), exact=True)
    assert _sorted(second) == _sorted(expected)
    # Readers of the first batch keep their table.
    assert _sorted(first) == _sorted(yearly_summary(enrich(filter_outliers(bars(spark, ROWS_1))), exact=True))
