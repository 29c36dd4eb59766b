"""Tables of versions, compaction, incremental yearly means, chart points."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from barframe.operators.aggregate import yearly_summary
from barframe.operators.charts import chart_points
from barframe.operators.clean import filter_outliers
from barframe.operators.enrich import enrich
from barframe.operators.modeling import ar1_coefficients, model_frame
from barframe.operators.stored_models import score_bars, store_models
from barframe.plans.incremental import absorb, yearly_means
from barframe.schema import schema_rows
from barframe.sources import compact, versions
from barframe.sources.compact import compact_landing, compacted_paths, landed_files, pack_files, read_compacted
from barframe.sources.inventory import file_inventory, inventory_report
from barframe.sources.readers import file_report, read_bars_json
from barframe.sources.versions import commits, find_version, read_version, write_version
from barframe.sources.writers import write_line_json
from barframe.streaming.ingest import run_new
from tests.conftest import bars, series

# ---------------------------------------------------------------- versions


def test_versions_and_old_readers(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    assert read_version(spark, path) is None and commits(spark, path).count() == 0
    assert write_version(spark.range(3).withColumn("ticker", F.lit("007")), path, partition_by=["ticker"], note="a") == 1
    old = read_version(spark, path)
    assert write_version(spark.range(5), path) == 2
    assert read_version(spark, path).count() == 5 and old.count() == 3
    assert [tuple(r) for r in read_version(spark, path, 1).orderBy("id").collect()] == [(i, "007") for i in range(3)]
    assert read_version(spark, path, 9) is None
    assert find_version(spark, path, 1).note == "a" and versions.has_note(spark, path, "a") and not versions.has_note(spark, path, "b")
    assert write_version(spark.range(0), path) == 3
    assert read_version(spark, path).columns == ["id"] and read_version(spark, path).count() == 0


def test_failed_overwrite_leaves_the_old_table(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    write_version(spark.range(3), path)
    broken = spark.range(10).select(F.raise_error(F.lit("stop")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="stop"):
        write_version(broken, path)
    # A commit that was begun and never finished names no version either.
    os.makedirs(f"{path}/commits/000000000002/_temporary/0")
    assert read_version(spark, path).count() == 3
    assert write_version(spark.range(4), path) == 2 and read_version(spark, path).count() == 4


def test_second_writer_is_told(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/t"
    write_version(spark.range(1), path)
    seen = find_version(spark, path)
    write_version(spark.range(2), path)
    answers = [seen]
    real = versions.find_version
    monkeypatch.setattr(versions, "find_version", lambda *a: answers.pop() if answers else versions.Version(2, "other", seen.schema, None))
    with pytest.raises(RuntimeError, match="another writer"):
        write_version(spark.range(3), path)
    monkeypatch.setattr(versions, "find_version", real)


# ---------------------------------------------------------------- compaction


def land_copies(folder, copies, ticker="AA", days=4, width=1):
    os.makedirs(folder, exist_ok=True)
    for c in copies:
        records = [
            {"Date": f"2020-01-{d + 1:02d}T00:00:00.000", "Open": c + 1.0, "High": 2.0, "Low": 0.5, "Close": 1.5, "Volume": 10.0, "Note": "x" * width}
            for d in range(days)
        ]
        with open(f"{folder}/{ticker}_{c}.json", "w") as f:
            f.write("\n".join(json.dumps(r) for r in records))


def rows_of(df):
    return sorted(tuple(map(str, r)) for r in df.drop("source").collect())


def test_501_copies_become_files_near_the_target(spark, tmp_dir):
    landing, store = f"{tmp_dir}/landing", f"{tmp_dir}/store"
    land_copies(landing, range(501))
    land_copies(landing, range(40), ticker="B B", width=30)
    before = rows_of(read_bars_json(spark, landing))
    total = {t: sum(os.path.getsize(f"{landing}/{n}") for n in os.listdir(landing) if n.startswith(t)) for t in ("AA", "B B")}
    assert compact_landing(spark, landing, store, target_bytes=20_000) == 541
    sizes = {}
    for folder, _dirs, names in os.walk(f"{store}/lines"):
        for n in names:
            if n.startswith("part-"):
                sizes.setdefault("B B" if "B" in folder.split("ticker=")[1] else "AA", []).append(os.path.getsize(f"{folder}/{n}"))
    for t, held in sizes.items():
        assert len(held) == -(-total[t] // 20_000)
        assert all(0.6 * 20_000 < s < 1.2 * 20_000 for s in held)
    assert rows_of(read_compacted(spark, landing, store)) == before
    assert compact_landing(spark, landing, store, target_bytes=20_000) == 0


def test_lines_move_as_they_are(spark, tmp_dir):
    landing, store = f"{tmp_dir}/landing", f"{tmp_dir}/store"
    os.makedirs(landing)
    lines = {
        "AA_3.json": ['{"Date": "2020-01-02", "Close": 1.50, "x": {"a": "}"}}', "broken{", "", "{}", " { } ", "[1]", '{"copy_id": 9, "Date": "2020-01-03"}', '{"copy_id": null, "Date": "2020-01-04"}', '{"Copy_ID": 7}'],
        "AA_original.json": ['{"Date": "2020-01-05", "ticker": "ZZ"}'],
        "AA.json": ['{"Date": "2020-01-06"}'],
        "A%20[b]{c}*+\\_4.json": ['{"Date": "2020-01-07"}'],
        "A%20[b]{c}*+\\_5.json": ['{"Date": "2020-01-08"}'],
    }
    for name, held in lines.items():
        with open(f"{landing}/{name}", "w") as f:
            f.write("\n".join(held))
    open(f"{landing}/AA_9.json", "w").close()
    readable = lambda path: rows_of(read_bars_json(spark, path).where(F.col("date").isNotNull()))
    before, report = readable(landing), file_report(spark, landing).agg(F.sum("n_records"), F.sum("n_malformed")).first()
    assert compact_landing(spark, landing, store) == 5
    paths = compacted_paths(spark, landing, store)
    moved = {r["value"] for r in spark.read.option("recursiveFileLookup", True).text(paths).collect()}
    assert '{"copy_id":3,"Date": "2020-01-02", "Close": 1.50, "x": {"a": "}"}}' in moved
    assert {"broken{", "[1]", '{"copy_id":3}', '{"copy_id": 9, "Date": "2020-01-03"}', '{"copy_id":3,"Date":"2020-01-04"}', '{"copy_id":3,"Copy_ID": 7}', '{"copy_id":0,"Date": "2020-01-05", "ticker": "ZZ"}'} <= moved
    assert '{"Date": "2020-01-06"}' in moved
    assert readable(paths) == before and len(before) == 7
    assert file_report(spark, paths).agg(F.sum("n_records"), F.sum("n_malformed")).first() == report


def test_interrupted_run_and_later_landings(spark, tmp_dir, monkeypatch):
    landing, store = f"{tmp_dir}/landing", f"{tmp_dir}/store"
    land_copies(landing, range(10))
    before = rows_of(read_bars_json(spark, landing))
    assert compacted_paths(spark, landing, store) == [landing]

    def stop(*a, **k):
        raise RuntimeError("stopped")

    monkeypatch.setattr(compact, "write_version", stop)
    with pytest.raises(RuntimeError, match="stopped"):
        compact_landing(spark, landing, store)
    assert rows_of(read_compacted(spark, landing, store)) == before
    monkeypatch.undo()
    assert compact_landing(spark, landing, store) == 10
    land_copies(landing, range(10, 13))
    after = rows_of(read_bars_json(spark, landing))
    assert len(after) == 52 and rows_of(read_compacted(spark, landing, store)) == after
    monkeypatch.setattr(compact, "write_version", stop)
    with pytest.raises(RuntimeError, match="stopped"):
        compact_landing(spark, landing, store)
    assert rows_of(read_compacted(spark, landing, store)) == after
    monkeypatch.undo()
    assert compact_landing(spark, landing, store) == 3
    # What the manifest names is no longer read from the landing.
    for n in os.listdir(landing):
        open(f"{landing}/{n}", "w").write("{}")
    assert rows_of(read_compacted(spark, landing, store)) == after


def test_bins(spark):
    sizes = [("AA", i, random.Random(i).randrange(1, 300)) for i in range(200)] + [("AA", 900, 1000), ("BB", 1, 5), ("CC", 1, 400), ("CC", 2, 999)]
    files = spark.createDataFrame([(f"file:/l/{t}_{i:03d}.json", n) for t, i, n in sizes], "source string, n_bytes bigint")
    rows = pack_files(files, 1000).collect()
    assert {r["ticker"] for r in rows} == {"AA", "CC"}  # BB has one small file, AA_900 is large enough
    total = sum(n for t, _i, n in sizes if t == "AA" and n < 1000)
    bins = {}
    for r in rows:
        bins.setdefault((r["ticker"], r["bin"]), []).append(r["n_bytes"])
    aa = [sum(v) for (t, _b), v in bins.items() if t == "AA"]
    assert len(aa) == -(-total // 1000) and all(abs(s - total / len(aa)) < 300 for s in aa) and sum(aa) == total
    assert pack_files(files.limit(0), 1000).count() == 0


# ---------------------------------------------------------------- incremental means


def means(df):
    return sorted((tuple(r) for r in df.select("year", "ticker", "avg_close", "avg_volatility").collect()), key=str)


def random_bars(n, seed):
    r = random.Random(seed)
    return [
        (r.choice("ABC"), f"{r.choice((2020, 2021))}-03-{r.randrange(1, 29):02d}", *[round(r.uniform(1, 9), 4) for _ in range(4)], float(r.randrange(100)))
        for _ in range(n)
    ]


def test_three_landings_equal_one(spark, tmp_dir):
    parts = [random_bars(60, s) for s in range(3)] + [[("D", "2022-01-01", 0.0, 1.0, 1.0, None, 1.0), (None, "2022-01-01", 1.0, 2.0, 1.0, float("nan"), 1.0)]]
    for i, rows in enumerate(parts):
        batch = enrich(bars(spark, rows))
        assert absorb(batch, f"{tmp_dir}/y", f"landing {i}")
        assert not absorb(batch, f"{tmp_dir}/y", f"landing {i}")
    every = enrich(bars(spark, sum(parts, [])))
    got = yearly_means(spark, f"{tmp_dir}/y")
    assert str(means(got)) == str(means(yearly_summary(every, exact=True)))
    raw = {(r["year"], r["ticker"]): r["avg_volatility"] for r in yearly_summary(every, volatility="raw").collect()}
    for r in got.collect():
        assert r["avg_raw_volatility"] == pytest.approx(raw[r["year"], r["ticker"]], nan_ok=True)
    assert means(yearly_means(spark, f"{tmp_dir}/y", 1)) == means(yearly_summary(enrich(bars(spark, parts[0])), exact=True))
    assert yearly_means(spark, f"{tmp_dir}/none") is None


def test_stream_takes_in_only_what_is_new(spark, tmp_dir):
    landing, out = f"{tmp_dir}/landing", f"{tmp_dir}/out"
    first, second = random_bars(40, 7), random_bars(40, 8)
    write_line_json(bars(spark, first), f"{landing}/batch=1")
    early = run_new(spark, landing, out)
    expected = lambda rows: means(yearly_summary(enrich(filter_outliers(bars(spark, rows))), exact=True))
    assert means(early) == expected(first)
    assert means(run_new(spark, landing, out)) == expected(first)  # nothing new
    write_line_json(bars(spark, second), f"{landing}/batch=2")
    assert means(run_new(spark, landing, out)) == expected(first + second)
    assert means(early) == expected(first)  # a reader of the former version keeps it
    assert commits(spark, f"{out}/yearly").count() == 2


# ---------------------------------------------------------------- chart points


def brute_points(rows, width):
    out = set()
    dates = [d for d, _v in rows]
    lo, hi = min(dates), max(dates)
    pixels = {}
    for d, v in rows:
        p = width - 1 if d == hi and lo < hi else (d - lo).days * width // ((hi - lo).days + 1)
        pixels.setdefault(p, []).append((d, v))
    for p, held in pixels.items():
        for d, v in (min(held), max(held), min(held, key=lambda r: (r[1], r[0])), min(held, key=lambda r: (-r[1], r[0]))):
            out.add((p, d, v))
    return out


@pytest.mark.parametrize("width", [1, 7, 50, 1000])
def test_chart_points_against_brute_force(spark, width):
    r = random.Random(width)
    closes = [float(r.randrange(1, 30)) for _ in range(300)]
    df = series(spark, closes)
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), c) for i, c in enumerate(closes)]
    got = [(p["pixel"], p["date"], p["close"]) for p in chart_points(df, width=width).collect()]
    assert len(got) == len(set(got)) <= 4 * width and set(got) == brute_points(rows, width)
    assert {max(closes), min(closes)} <= {c for _p, _d, c in got}


def test_chart_points_of_odd_series(spark):
    rows = [("A", "2024-01-01", 1.0, 1.0, 1.0, 5.0, 1.0), (None, "2024-01-01", 1.0, 1.0, 1.0, 2.0, 1.0), (None, "2024-01-01", 1.0, 1.0, 1.0, 3.0, 1.0)]
    rows += [("B", "2024-01-01", 1.0, 1.0, 1.0, float("nan"), 1.0), ("B", "2024-01-02", 1.0, 1.0, 1.0, None, 1.0)]
    df = bars(spark, rows)
    got = sorted(((r["ticker"], r["pixel"], r["close"]) for r in chart_points(df, width=3).collect()), key=str)
    assert got == [("A", 0, 5.0), (None, 0, 2.0), (None, 0, 3.0)]
    copies = df.withColumn("copy_id", F.lit(1))
    assert chart_points(copies, width=3).columns == ["ticker", "copy_id", "pixel", "date", "close"]
    assert chart_points(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        chart_points(df, width=0)


# ---------------------------------------------------------------- inventory


def test_inventory_sees_empty_and_missing_files(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/ticker=A B/deep/er")
    os.makedirs(f"{tmp_dir}/_hidden")
    os.makedirs(f"{tmp_dir}/bare")
    held = {
        "AA.json": '{"Date":"2020-01-02"}', "ticker=A B/deep/er/z_1.json": "", "ticker=A B/x.json": "{", "blank.json": "\n", "_hidden/h.json": "{}",
        "é %20&+[a]{b}?.json": '{"Date":"2020-01-02"}',
    }
    for name, text in held.items():
        with open(f"{tmp_dir}/{name}", "w") as f:
            f.write(text)
    inventory = file_inventory(spark, tmp_dir)
    sizes = {r["path"]: r["n_bytes"] for r in inventory.collect()}
    assert sizes == {n: len(t) for n, t in held.items() if n != "_hidden/h.json"}
    scanned = {r["source"] for r in landed_files(spark, tmp_dir).collect()}
    assert {r["source"] for r in inventory.where("n_bytes > 0").collect()} == scanned
    expected = spark.createDataFrame([("AA.json",), ("CC_2.json",), ("CC_2.json",), (None,)], "path string")
    rows = inventory_report(file_report(spark, tmp_dir), inventory, expected).collect()
    assert {(r["path"], r["ticker"], r["n_records"], r["status"]) for r in rows} == {
        ("AA.json", "AA", 1, "ok"), ("ticker=A B/deep/er/z_1.json", "A B", 0, "empty"), ("ticker=A B/x.json", "A B", 1, "broken"),
        ("blank.json", "blank", 0, "empty"), ("é %20&+[a]{b}?.json", "é  &+[a]{b}?", 1, "ok"), ("CC_2.json", "CC", 0, "missing"),
    }
    assert len(rows) == 6
    assert inventory_report(file_report(spark, tmp_dir), inventory).count() == 5
    assert file_inventory(spark, f"{tmp_dir}/none").count() == 0


# ---------------------------------------------------------------- stored models


def test_later_bars_are_scored_without_a_refit(spark, tmp_dir):
    r = random.Random(3)
    closes = [round(50 + 10 * r.random(), 2) for _ in range(260)]
    every = series(spark, closes).unionByName(series(spark, closes[:5], ticker="NEW", start="2024-09-01"))
    end = dt.date(2024, 8, 31)
    frame = model_frame(every.where(F.col("date") <= F.lit(end)), "close")
    path = f"{tmp_dir}/m"
    with pytest.raises(ValueError, match="no stored models"):
        score_bars(spark, every, path)
    assert store_models(frame, path) == 1
    model = read_version(spark, path).first()
    fit = ar1_coefficients(frame).first()
    assert (model["slope"], model["intercept"], model["n_fit"]) == (fit["slope"], fit["intercept"], fit["n_fit"])
    assert model["last_date"] == end
    got = {(g["ticker"], g["date"]): g for g in score_bars(spark, every, path).collect()}
    days = {dt.date(2024, 1, 1) + dt.timedelta(days=i): c for i, c in enumerate(closes)}
    assert {d for t, d in got if t == "T"} == {d for d in days if d > end}
    for (t, d), g in got.items():
        if t == "NEW":
            assert (g["status"], g["predicted"]) == ("no model", None)
            continue
        before = days[d - dt.timedelta(days=1)]
        span = model["hi"] - model["lo"]
        assert g["predicted"] == pytest.approx((model["intercept"] + model["slope"] * (before - model["lo"]) / span) * span + model["lo"])
        assert (g["status"], g["actual"], g["last_value"]) == ("ok", days[d], before)
    # A later version does not change what an earlier one gives.
    store_models(model_frame(every.withColumn("close", F.col("close") * 2), "close"), path)
    again = {(g["ticker"], g["date"]): g for g in score_bars(spark, every, path, number=1).collect()}
    assert again == got
    with pytest.raises(ValueError, match="predict 'close'"):
        score_bars(spark, every, path, "volume")


def test_scores_of_odd_bars(spark, tmp_dir):
    path = f"{tmp_dir}/m"
    models = spark.createDataFrame(
        [("A", 0.5, 0.25, 9, 1.0, 5.0, dt.date(2024, 1, 1), 3.0), ("B", None, None, 0, 1.0, 1.0, dt.date(2024, 1, 1), 1.0), (None, 0.5, 0.25, 9, 2.0, 2.0, dt.date(2024, 1, 1), 2.0)],
        "ticker string, slope double, intercept double, n_fit bigint, lo double, hi double, last_date date, last_value double",
    )
    write_version(models, path, note="close")
    bar = lambda t, d, c: (t, d, 1.0, 1.0, 1.0, c, 1.0)
    new = bars(spark, [bar("A", "2024-01-01", 9.0), bar("A", "2024-01-02", None), bar("A", "2024-01-03", 4.0), bar("A", "2024-01-04", 5.0), bar("B", "2024-01-02", 1.0), bar(None, "2024-01-02", 2.0)])
    got = sorted(((g["ticker"], g["date"].day, g["predicted"], g["last_value"], g["status"]) for g in score_bars(spark, new, path).collect()), key=str)
    assert got == sorted(
        [("A", 2, 3.0, 3.0, "ok"), ("A", 3, None, None, "no value before"), ("A", 4, 3.5, 4.0, "ok"), ("B", 2, None, 1.0, "no fit"), (None, 2, 2.0, 2.0, "ok")], key=str
    )
    assert score_bars(spark, new.limit(0), path).count() == 0
    with pytest.raises(ValueError, match="bars by"):
        score_bars(spark, new.withColumn("copy_id", F.lit(1)), path)


def test_schema_rows(spark):
    df = bars(spark, [("A", "2024-01-01", 1.0, None, 1.0, 5.0, 1.0), (None, "2024-01-01", 1.0, None, 1.0, 2.0, 1.0)])
    rows = {r["name"]: tuple(r)[2:] for r in schema_rows(df).collect()}
    assert rows["ticker"] == ("string", True, 2, 1) and rows["high"] == ("double", True, 2, 2) and rows["date"] == ("date", True, 2, 0)
    assert [r["position"] for r in schema_rows(df.toDF(*"abcdefg")).collect()] == list(range(7))
    assert [r["n_rows"] for r in schema_rows(df.limit(0)).collect()] == [0] * 7
    assert schema_rows(df.select()).count() == 0
