import hashlib

from pyspark.sql import functions as F

from barframe.operators.multiply import add_noise, multiply_bars, replicate
from tests.conftest import bars

ROWS = [
    ("AAPL", "2024-01-02", 100.0, 110.0, 90.0, 105.0, 1000.0),
    ("AAPL", "2024-01-03", 101.0, 111.0, 91.0, 106.0, 2000.0),
    ("MSFT", "2024-01-02", 50.0, 55.0, 45.0, 52.0, 500.0),
]


def _py_factor(ticker, date, copy_id, seed, slot, amp):
    """Pure-Python statement of the noise rule, written independently of the Spark code."""
    if copy_id == 0:
        return 1.0
    digest = hashlib.sha256(f"{ticker}|{date}|{seed}".encode()).hexdigest()
    x = (int(digest[8 * slot : 8 * slot + 8], 16) + copy_id * 0x9E3779B1) & 0xFFFFFFFF
    for _ in range(2):
        x = (((x >> 16) ^ x) * 0x45D9F3B) & 0xFFFFFFFF
    x = (x >> 16) ^ x
    u = x / 4294967296.0
    return 1.0 + amp * (2.0 * u - 1.0)


def test_row_count_and_original(spark):
    df = bars(spark, ROWS)
    out = multiply_bars(df, copies=7, seed=42)
    assert out.count() == 8 * len(ROWS)
    orig = out.filter("copy_id = 0").drop("copy_id")
    assert sorted(orig.collect()) == sorted(df.collect())


def test_noise_equals_python_rule(spark):
    out = multiply_bars(bars(spark, ROWS), copies=3, seed=42).collect()
    base = {(r[0], r[1]): r for r in ROWS}
    for r in out:
        src = base[(r.ticker, r.date.isoformat())]
        for slot, (name, amp) in enumerate([("open", 0.02), ("high", 0.02), ("low", 0.02), ("close", 0.02), ("volume", 0.05)]):
            exp = src[2 + slot] * _py_factor(r.ticker, r.date.isoformat(), r.copy_id, 42, slot, amp)
            assert r[name] == exp


def test_seed_determinism_and_bounds(spark):
    df = bars(spark, ROWS)
    a = sorted(multiply_bars(df, 5, seed=42).collect())
    b = sorted(multiply_bars(df, 5, seed=42, partitions=3).collect())
    c = sorted(multiply_bars(df, 5, seed=43).collect())
    assert a == b and a != c
    f = multiply_bars(df, 50, seed=1).join(df.select("ticker", "date", F.col("close").alias("c0"), F.col("volume").alias("v0")), ["ticker", "date"])
    r = f.select(F.min(F.col("close") / F.col("c0")), F.max(F.col("close") / F.col("c0")), F.min(F.col("volume") / F.col("v0")), F.max(F.col("volume") / F.col("v0"))).first()
    assert 0.98 <= r[0] and r[1] <= 1.02 and 0.95 <= r[2] and r[3] <= 1.05


def test_missing_and_null_fields(spark):
    df = bars(spark, [("X", "2024-01-02", None, 2.0, 1.0, 1.5, 10.0)]).drop("high")
    out = add_noise(replicate(df, 2), 42).collect()
    assert "high" not in out[0].asDict() and all(r.open is None for r in out)


def test_independent_of_precomputed_words(spark):
    df = bars(spark, ROWS)
    fast = sorted(multiply_bars(df, 4, seed=9).collect())
    slow = sorted(add_noise(replicate(df, 4, partitions=0), 9).collect())
    assert fast == slow


def test_a_bar_alone_is_copied_by_many_tasks(spark):
    one = bars(spark, ROWS[:1]).coalesce(1)
    out = multiply_bars(one, 500, seed=7)
    per_task = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in per_task) == 501 and len(per_task) >= 4
    assert sorted(out.collect()) == sorted(multiply_bars(one, 500, seed=7, partitions=1, range_copies=501).collect())
    assert sorted(r["copy_id"] for r in replicate(one, 65, include_original=False).collect()) == list(range(1, 66))
    assert replicate(one, 0).count() == 1 and replicate(one, 0, include_original=False).count() == 0
