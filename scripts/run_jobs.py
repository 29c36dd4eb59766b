"""Run the three jobs end to end on a driver-table scale factor and print small summaries.

Usage: python scripts/run_jobs.py [sf_dir] [copies]

1. small job: JSON-array landing (one array per ticker) → Parquet → profile → strict clean →
   enrich → Parquet by year → yearly means;
2. large job: noisy copies landed as line JSON in one write → one scan → close/volume clean →
   enrich → Parquet by year → yearly means + coverage against the supplier list;
3. forecast job: indicators → scaling → sequences → split → AR(1) → metrics and a 30-day path,
   for every series.

Outputs go under the session's shared work folder (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from barframe.plans import jobs  # noqa: E402
from barframe.plans.workspace import scratch_path  # noqa: E402
from barframe.sources.fixtures import bars_lineitem, bars_supplier, expected_suppliers  # noqa: E402
from barframe.sources.writers import write_json_arrays  # noqa: E402


def step(name: str, t0: float) -> float:
    t1 = time.perf_counter()
    print(f"-- {name}: {t1 - t0:.1f}s")
    return t1


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    spark = (
        SparkSession.builder.appName("barframe-jobs")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    base = scratch_path(spark, "jobs")
    print(f"work folder: {base}")
    t = time.perf_counter()

    write_json_arrays(bars_lineitem(spark, sf), f"{base}/small/landing")
    small = jobs.landing_to_yearly(spark, f"{base}/small/landing", f"{base}/small/out", exact=True)
    small.profile.orderBy("field", F.col("stage").desc()).show(10, truncate=False)
    small.yearly.orderBy("year", "ticker").show(10)
    t = step("small job", t)

    jobs.land_copies(bars_supplier(spark, sf), f"{base}/large/landing", copies=copies)
    large = jobs.copies_to_yearly(spark, f"{base}/large/landing", f"{base}/large/out", expected_suppliers(spark, sf))
    large.coverage.groupBy("status").count().show()
    print(f"clean bars: {large.clean.count()}, yearly rows: {large.yearly.count()}")
    t = step(f"large job ({copies} copies)", t)

    fc = jobs.forecast_all(bars_supplier(spark, sf), "close", 30)
    fc.metrics.select(F.avg("rmse").alias("avg_rmse"), F.avg("rmse_last_value").alias("avg_rmse_last_value")).show()
    fc.forecast.orderBy("ticker", "step").show(5)
    step("forecast job", t)
    spark.stop()


if __name__ == "__main__":
    main()
