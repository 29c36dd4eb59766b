import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from barframe.operators.modeling import make_sequences
from barframe.operators.sequence_store import pack_sequences, read_sequences, unpack_sequences, write_sequences
from barframe.operators.spread import spread
from barframe.plans.catalog import QUERIES, checksummed
from tests.conftest import SF001

SIZES = {"short": 4, "five": 5, "one": 63, "exact": 128, "long": 700, None: 90}


@pytest.fixture(scope="module")
def rows(spark):
    data = [
        (t, dt.date(2020, 1, 1) + dt.timedelta(days=i), float(i), None if i % 7 == 0 else i / 3, float(i * i % 11))
        for t, n in SIZES.items() for i in range(n)
    ]
    return spark.createDataFrame(data, "ticker string, date date, close double, volume double, extra double")


def seen(df):
    return sorted((str(r["ticker"]), r["date"], r["seq_len"], r["pos"], r["label"], str([list(s) for s in r["sequence"]])) for r in df.collect())


@pytest.mark.parametrize("block_rows, block", [(64, None), (512, None), (64, "month")])
def test_equals_sliding_windows(spark, rows, block_rows, block):
    want = seen(make_sequences(rows, ["close", "volume"], "close", keys=["ticker"]))
    blocks = pack_sequences(rows, ["close", "volume"], "close", keys=["ticker"], block_rows=block_rows, block=block)
    assert seen(unpack_sequences(blocks)) == want


def test_a_row_is_stored_at_most_twice(spark, rows):
    blocks = pack_sequences(rows, ["close"], "close", keys=["ticker"], block_rows=64)
    stored = blocks.select("ticker", F.explode("dates").alias("date")).groupBy("ticker", "date").count()
    assert stored.agg(F.max("count")).first()[0] == 2
    assert blocks.agg(F.max(F.size("steps"))).first()[0] <= 64 + 60
    assert {r["ticker"] for r in blocks.collect()} == set(SIZES) - {"short"}


def test_written_store(spark, rows, tmp_dir):
    blocks = pack_sequences(rows, ["close", "extra"], "extra", keys=["ticker"])
    write_sequences(blocks, f"{tmp_dir}/store")
    assert seen(read_sequences(spark, f"{tmp_dir}/store")) == seen(unpack_sequences(blocks))
    assert unpack_sequences(pack_sequences(rows.limit(0), ["close"], "close", keys=["ticker"])).count() == 0
    with pytest.raises(ValueError, match="block_rows"):
        pack_sequences(rows, ["close"], "close", block_rows=59)


def test_a_generators_input_is_dealt_out(spark, rows):
    one = rows.coalesce(1)
    assert spread(one, "ticker", "date").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    used = {r["p"] for r in spread(one, "ticker", "date").select(F.spark_partition_id().alias("p")).distinct().collect()}
    assert len(used) >= min(8, spark.sparkContext.defaultParallelism)
    assert spread(one, "ticker", partitions=3).rdd.getNumPartitions() == 3


def test_checksum_of_every_number_without_lambdas(spark, rows):
    seqs = make_sequences(rows, ["close", "volume"], "close", keys=["ticker"])
    got = {(r["ticker"], r["pos"]): r for r in checksummed(seqs, 2).collect()}
    want = {(r["ticker"], r["pos"]): r for r in seqs.collect()}
    assert set(got) == set(want)
    for key, r in want.items():
        flat = [v for step in r["sequence"] for v in step]
        total = None if None in flat else sum(math.floor(v * 1e6 + 0.5) * (i + 1) for i, v in enumerate(flat))
        assert (got[key]["checksum"], got[key]["n_steps"], got[key]["date"], got[key]["label"]) == (total, len(r["sequence"]), r["date"], r["label"])
    assert any(r["checksum"] is None for r in got.values()) and any(r["checksum"] is not None for r in checksummed(seqs.select("*").withColumn("sequence", F.expr("transform(sequence, s -> array(s[0], s[0]))")), 2).collect())
    for name in ("sequences",):
        assert "aggregate(" not in QUERIES[name](spark, SF001)._jdf.queryExecution().optimizedPlan().toString().replace("Aggregate", "")
