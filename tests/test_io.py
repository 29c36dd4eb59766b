import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from barframe.functions.expressions import ticker_from_path
from barframe.operators.union import union_by_name
from barframe.sources.readers import copy_from_path, read_bars_json, read_bars_parquet, read_wrapped_json
from barframe.sources.writers import (
    to_json_records,
    write_json_arrays,
    write_line_json,
    write_parquet,
    write_text,
    write_wrapped_json,
)
from tests.conftest import bars

ROWS = [
    ("AAPL", "2024-01-02", 100.0, 110.0, 90.0, 105.0, 1000.0),
    ("AAPL", "2024-01-03", 101.0, 111.0, 91.0, 106.0, 2000.0),
    ("007", "2024-01-02", 50.0, 55.0, 45.0, 52.0, 500.0),
]
COLS = ["ticker", "date", "open", "high", "low", "close", "volume"]


def _canon(df):
    return sorted(tuple(r) for r in df.select(*COLS).collect())


@pytest.mark.parametrize(
    "path,ticker,copy",
    [
        ("hdfs://nn/raw/AAPL.json", "AAPL", None),
        ("file:/x/raw/AAPL_12.json/part-00000-abc.json", "AAPL", 12),
        ("file:/x/raw/BRK.B_original.json/part-00000.txt", "BRK.B", 0),
        ("file:/x/merged/META_merged.json/part-00001.json", "META", None),
        ("file:/x/land/ticker=007/copy_id=3/part-0.json", "007", 3),
        ("file:/x/raw/part-0000.parquet", None, None),
    ],
)
def test_path_parsing(spark, path, ticker, copy):
    r = spark.createDataFrame([(path,)], "p string").select(ticker_from_path("p").alias("t"), copy_from_path("p").alias("c")).first()
    assert (r.t, r.c) == (ticker, copy)


def test_json_array_files_flat_layout(spark, tmp_dir):
    """Reference landing: one JSON array per ticker in <TICKER>.json, ISO date strings."""
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    for t, recs in {"AAPL": ROWS[:2], "007": ROWS[2:]}.items():
        arr = [{"Date": f"{r[1]}T00:00:00.000", "Open": r[2], "High": r[3], "Low": r[4], "Close": r[5], "Volume": int(r[6]), "Adj Close": 1.0} for r in recs]
        with open(os.path.join(raw, f"{t}.json"), "w") as f:
            f.write(json.dumps(arr))
    df = read_bars_json(spark, f"{raw}/*.json", multiline=True)
    assert _canon(df) == _canon(bars(spark, ROWS))
    assert df.filter(F.col("source").endswith("AAPL.json")).count() == 2


def test_json_arrays_round_trip(spark, tmp_dir):
    src = bars(spark, ROWS)
    write_json_arrays(src, f"{tmp_dir}/arr")
    assert _canon(read_bars_json(spark, f"{tmp_dir}/arr", multiline=True)) == _canon(src)
    # the record layout is the landed one
    one = json.loads(to_json_records(src).filter("ticker = 'AAPL'").first().json)
    assert one[0]["Date"] == "2024-01-02T00:00:00.000" and list(one[0]) == ["Date", "Open", "High", "Low", "Close", "Volume"]


def test_line_json_copies_all_records_read(spark, tmp_dir):
    """Line JSON must be read without multiLine, or only the first record of each file survives."""
    from barframe.operators.multiply import multiply_bars

    src = multiply_bars(bars(spark, ROWS), copies=2, seed=1)
    write_line_json(src, f"{tmp_dir}/land")
    back = read_bars_json(spark, f"{tmp_dir}/land")
    assert back.count() == 9
    assert sorted(tuple(r) for r in back.select("ticker", "copy_id", "date", "close").collect()) == sorted(
        tuple(r) for r in src.select("ticker", "copy_id", "date", "close").collect()
    )
    assert back.filter("ticker = '007'").count() == 3  # not turned into the number 7


def test_wrapped_json_and_text(spark, tmp_dir):
    src = bars(spark, ROWS)
    write_wrapped_json(src, f"{tmp_dir}/wrapped")
    assert _canon(read_wrapped_json(spark, f"{tmp_dir}/wrapped")) == _canon(src)
    write_text(to_json_records(src), f"{tmp_dir}/text", "json", partition_by=["ticker"])
    assert _canon(read_wrapped_json(spark, f"{tmp_dir}/text", text=True)) == _canon(src)


def test_parquet_modes(spark, tmp_dir):
    src = bars(spark, ROWS).withColumn("year", F.year("date"))
    write_parquet(src, f"{tmp_dir}/pq", partition_by=["year"])
    assert _canon(read_bars_parquet(spark, f"{tmp_dir}/pq")) == _canon(src)
    with pytest.raises(AnalysisException):
        write_parquet(src, f"{tmp_dir}/pq", mode="errorifexists")
    write_parquet(src, f"{tmp_dir}/pq", mode="overwrite")
    # pushdown reaches the scan
    plan = read_bars_parquet(spark, f"{tmp_dir}/pq").filter("close > 100")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(close), GreaterThan(close,100.0)]" in plan


def test_union_by_name_keeps_values_in_place(spark):
    a = bars(spark, ROWS[:1])
    b = bars(spark, ROWS[1:]).select("volume", "close", "low", "high", "open", "date", "ticker")
    u = union_by_name([a, b, bars(spark, ROWS[:1]).withColumn("extra", F.lit("x"))])
    assert u.count() == 4 and u.filter("extra is null").count() == 3
    assert sorted(r.close for r in u.collect()) == [52.0, 105.0, 105.0, 106.0]


def test_reference_copy_layout_single_glob(spark, tmp_dir):
    """One Spark output directory per copy (<TICKER>_<n>.json/, <TICKER>_original.json/), all read by one glob."""
    from barframe.operators.multiply import multiply_bars
    from barframe.sources.writers import landed_records

    src = multiply_bars(bars(spark, ROWS), copies=2, seed=3)
    for (t, c) in [(r.ticker, r.copy_id) for r in src.select("ticker", "copy_id").distinct().collect()]:
        name = f"{t}_original.json" if c == 0 else f"{t}_{c}.json"
        part = landed_records(src.filter((F.col("ticker") == t) & (F.col("copy_id") == c))).drop("ticker", "copy_id")
        part.coalesce(1).write.json(f"{tmp_dir}/raw/{name}")
    back = read_bars_json(spark, f"{tmp_dir}/raw/*_*.json")
    key = ["ticker", "copy_id", "date", "open", "close", "volume"]
    assert sorted(tuple(r) for r in back.select(*key).collect()) == sorted(tuple(r) for r in src.select(*key).collect())


def test_iso_strings_to_date_and_timestamp(spark):
    import datetime as dt

    from barframe.functions.expressions import to_bar_date, to_bar_timestamp

    df = spark.createDataFrame([("2000-01-03T00:00:00.000",), ("not a date",)], "s string")
    got = df.select(to_bar_date("s").alias("d"), to_bar_timestamp("s").alias("t")).collect()
    assert got[0].d == dt.date(2000, 1, 3) and got[0].t == dt.datetime(2000, 1, 3)
    assert got[1].d is None and got[1].t is None


def test_bucketed_bars_remove_window_exchange(spark, tmp_dir):
    import uuid

    from barframe.operators.indicators import indicators
    from barframe.sources.writers import write_bucketed_bars

    name = f"t_{uuid.uuid4().hex[:8]}"
    write_bucketed_bars(bars(spark, ROWS), name, f"{tmp_dir}/bucketed", buckets=4, keys=["ticker"])
    ind = indicators(spark.table(name), dropna=False)
    plan = ind._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert sorted(map(tuple, ind.collect())) == sorted(map(tuple, indicators(bars(spark, ROWS), dropna=False).collect()))


def test_path_parsing_property(spark):
    """Generated tickers and copy numbers survive every landing layout, checked in one Spark pass."""
    from hypothesis import given, settings
    from hypothesis import strategies as st

    tickers = st.from_regex(r"[A-Z0-9][A-Z0-9.\-]{0,7}", fullmatch=True)
    layouts = st.sampled_from(["flat", "copy", "original", "merged", "hive"])
    cases_seen = []

    @settings(max_examples=1, deadline=None)
    @given(st.lists(st.tuples(tickers, st.integers(1, 100000), layouts), min_size=200, max_size=200))
    def check(cases):
        rows, expected = [], []
        for t, c, layout in cases:
            if layout == "flat":
                rows.append(f"file:/d/raw/{t}.json"), expected.append((t, None))
            elif layout == "copy":
                rows.append(f"hdfs://nn/raw/{t}_{c}.json/part-00000-x.json"), expected.append((t, c))
            elif layout == "original":
                rows.append(f"hdfs://nn/raw/{t}_original.json/part-00000.txt"), expected.append((t, 0))
            elif layout == "merged":
                rows.append(f"file:/d/merged/{t}_merged.json/part-1.json"), expected.append((t, None))
            else:
                rows.append(f"s3a://b/land/ticker={t}/copy_id={c}/part-0.json"), expected.append((t, c))
        df = spark.createDataFrame([(i, p) for i, p in enumerate(rows)], "i int, p string")
        got = df.select("i", ticker_from_path("p").alias("t"), copy_from_path("p").alias("c")).orderBy("i").collect()
        assert [(r.t, r.c) for r in got] == expected
        cases_seen.append(len(cases))

    check()
    assert cases_seen == [200]


def test_odd_tickers_survive_the_landing(spark, tmp_dir):
    names = ["^GSPC", "EURUSD=X", "BRK B", "A/B", "100%", "A+B", "%5E", None]
    rows = [(t, "2024-01-02", 1.0, 2.0, 0.5, 1.5, 10.0 + i) for i, t in enumerate(names)]
    write_line_json(bars(spark, rows), f"{tmp_dir}/landing", partition_by=["ticker"])
    back = {r.volume: r.ticker for r in read_bars_json(spark, f"{tmp_dir}/landing").collect()}
    assert [back[10.0 + i] for i in range(len(names))] == names


def test_folder_of_copy_directories_is_read_whole(spark, tmp_dir):
    row = [("AAPL", "2024-01-02", 1.0, 2.0, 0.5, 1.5, 10.0)]
    for name in ("AAPL_original.json", "AAPL_1.json", "AAPL_2.json"):
        write_line_json(bars(spark, row), f"{tmp_dir}/raw/{name}", partition_by=None)
    back = sorted((r.ticker, r.copy_id) for r in read_bars_json(spark, f"{tmp_dir}/raw").collect())
    assert back == [("AAPL", 0), ("AAPL", 1), ("AAPL", 2)]


def test_merged_landing_keeps_the_copies(spark, tmp_dir):
    from barframe.operators.multiply import multiply_bars

    src = multiply_bars(bars(spark, ROWS), copies=2, seed=4)
    write_line_json(src, f"{tmp_dir}/copies", partition_by=["ticker", "copy_id"])
    write_line_json(read_bars_json(spark, f"{tmp_dir}/copies"), f"{tmp_dir}/merged")
    key = ["ticker", "copy_id", "date", "open", "close", "volume"]
    back = read_bars_json(spark, f"{tmp_dir}/merged")
    assert sorted(tuple(r) for r in back.select(*key).collect()) == sorted(tuple(r) for r in src.select(*key).collect())


def test_flat_merged_file_keeps_the_copies(spark, tmp_dir):
    src = bars(spark, ROWS[:1]).withColumn("copy_id", F.explode(F.array(F.lit(0), F.lit(1), F.lit(7))))
    write_line_json(src.drop("ticker"), f"{tmp_dir}/raw/AAPL_merged.json", partition_by=None)
    back = sorted((r.ticker, r.copy_id) for r in read_bars_json(spark, f"{tmp_dir}/raw").collect())
    assert back == [("AAPL", 0), ("AAPL", 1), ("AAPL", 7)]


def test_arrays_are_cut_by_year(spark, tmp_dir):
    rows = [("AAPL", f"{y}-01-0{d}", 1.0, 2.0, 0.5, 1.5, 10.0 * d + y) for y in (2020, 2021, 2022) for d in (2, 3)]
    src = bars(spark, rows)
    assert to_json_records(src).count() == 3 and to_json_records(src, chunk=None).count() == 1
    write_json_arrays(src, f"{tmp_dir}/arr")
    assert _canon(read_bars_json(spark, f"{tmp_dir}/arr", multiline=True)) == _canon(src)
    write_wrapped_json(src, f"{tmp_dir}/wrapped")
    assert _canon(read_wrapped_json(spark, f"{tmp_dir}/wrapped")) == _canon(src)


def test_file_report_names_every_fault(spark, tmp_dir):
    import os

    from barframe.sources.readers import checked_records, file_report

    good = '{"Date":"2024-01-02T00:00:00.000","Open":1.0,"High":2.0,"Low":0.5,"Close":1.5,"Volume":10.0}'
    files = {
        "GOOD": [good, good],
        "PART": [good, good[:40], good.replace("2024-01-02T00:00:00.000", "soon"), good.replace("10.0", "null")],
        "BAD": ["{", "not json"],
        "TEXT": [good.replace("1.5", '"much"')],
        "NONE": ["", ""],
    }
    os.makedirs(f"{tmp_dir}/raw")
    for name, lines in files.items():
        with open(f"{tmp_dir}/raw/{name}.json", "w") as f:
            f.write("\n".join(lines))
    cols = ["status", "n_records", "n_malformed", "n_no_date", "n_incomplete"]
    got = {r.ticker: tuple(r[c] for c in cols) for r in file_report(spark, f"{tmp_dir}/raw").collect()}
    assert got == {
        "GOOD": ("ok", 2, 0, 0, 0),
        "PART": ("faulty", 4, 1, 1, 1),
        "BAD": ("broken", 2, 2, 0, 0),
        "TEXT": ("broken", 1, 1, 0, 0),
        "NONE": ("empty", 0, 0, 0, 0),
    }
    texts = {r.record for r in checked_records(spark, f"{tmp_dir}/raw").where("problem = 'malformed'").collect()}
    assert texts == {good[:40], "{", "not json", files["TEXT"][0]}


def test_many_folders_are_listed_in_few_tasks(spark, tmp_dir):
    """A landing of more folders than four times the cores: the listing has no task for each, and the setting is as before."""
    cores = spark.sparkContext.defaultParallelism
    tickers = [f"T{i}" for i in range(4 * cores + 40)]
    write_line_json(bars(spark, [(t, "2024-01-02", 1.0, 2.0, 0.5, 1.5, 10.0) for t in tickers]), f"{tmp_dir}/landing")
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        back = read_bars_json(spark, f"{tmp_dir}/landing")
        tracker = spark.sparkContext.statusTracker()
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert stages and max(s.numTasks for s in stages) <= 4 * cores
    assert spark.conf.get(key) == before
    assert sorted(r["ticker"] for r in back.select("ticker").collect()) == sorted(tickers)
