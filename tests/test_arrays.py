"""JSON arrays read by byte ranges, against Python's reading of whole files."""

import json
import os
import random

import pytest

from barframe.sources.arrays import array_records, read_array_bars
from barframe.sources.readers import read_bars_json


@pytest.fixture()
def small_splits(spark):
    keys = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    old = {k: spark.conf.get(k) for k in keys}
    yield lambda n: [spark.conf.set(k, str(v)) for k, v in zip(keys, (n, 1))]
    for k, v in old.items():
        spark.conf.set(k, v)


def objects(r, n):
    odd = ["}", "{", '"', "\\", "\\\\\"}", "},{", "[", "]", "é}", "\n", "", "plain", '"}{"', "\\u007d"]
    out = []
    for i in range(n):
        o = {"Date": f"2020-01-{i % 28 + 1:02d}T00:00:00.000", "Close": float(i), "Note": "".join(r.choices(odd, k=r.randrange(4)))}
        if r.random() < 0.3:
            o["Deep"] = {r.choice(odd) + "k": [{"x": r.choice(odd)}, {}, [{"y": {}}]]}
        out.append(o)
    return out


@pytest.mark.parametrize("size", [17, 64, 300, 1 << 20])
def test_every_record_whatever_the_splits(spark, tmp_dir, small_splits, size):
    r = random.Random(size)
    files = {f"T{i}.json": objects(r, n) for i, n in enumerate((0, 1, 40, 60))}
    for i, (name, held) in enumerate(files.items()):
        with open(f"{tmp_dir}/{name}", "w") as f:
            json.dump(held, f, indent=[None, 2][i % 2], ensure_ascii=i < 2)
    small_splits(size)
    rows = array_records(spark, tmp_dir).collect()
    for name, held in files.items():
        got = [json.loads(x["record"]) for x in rows if x["source"].endswith("/" + name)]
        assert sorted(map(json.dumps, got)) == sorted(map(json.dumps, held))
    bars = lambda df: sorted(tuple(map(str, x)) for x in df.collect())
    assert bars(read_array_bars(spark, tmp_dir)) == bars(read_bars_json(spark, tmp_dir, multiline=True))


def test_files_that_are_no_arrays(spark, tmp_dir, small_splits):
    texts = {
        "empty.json": "", "blank.json": " \n", "bare.json": "[]", "one.json": '{"Close": 1, "x": {"y": "}"}}',
        "two.json": '[{"Close": 2}] [{"Close": 3}]', "cut.json": '[{"Close": 4}, {"Close": 5, "x": {"y": 1}, ', "null.json": '[null, {"Close": 6}, 7]',
        "long.json": json.dumps([{"Close": 8, "x": "{}" * 5000, "y": [{}] * 50}]),
    }
    for name, text in texts.items():
        with open(f"{tmp_dir}/{name}", "w") as f:
            f.write(text)
    small_splits(256)
    got = sorted((os.path.basename(x["source"]), json.loads(x["record"])["Close"]) for x in array_records(spark, tmp_dir).collect())
    assert got == [("cut.json", 4), ("long.json", 8), ("null.json", 6), ("one.json", 1), ("two.json", 2), ("two.json", 3)]
    assert len(read_array_bars(spark, f"{tmp_dir}/bare.json").collect()) == 0
