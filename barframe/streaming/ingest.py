"""The clean → enrich → yearly plan over a landing folder, with Structured Streaming.

Landed files (line JSON or JSON arrays) are picked up incrementally by the file source; the
per-bar operators (cleaning, enrichment) are stateless, so the same functions as in batch mode
apply unchanged. The yearly means are a streaming aggregation whose state is one row per
(year, ticker) — bounded by the number of tickers times years, not by the data volume.

Exactly-once output: the enriched bars go to a Parquet sink (append, file-sink log); the yearly
means are written per micro-batch by ``foreachBatch`` into a folder of the batch, so a replayed
batch rewrites the same result and readers of an earlier one keep a whole table. Checkpoints live under the shared checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barframe.operators.aggregate import mean
from barframe.operators.clean import filter_outliers
from barframe.operators.enrich import enrich
from barframe.plans.incremental import absorb, yearly_means
from barframe.plans.workspace import scratch_path
from barframe.schema import LANDED_SCHEMA
from barframe.sources.readers import normalize_landed


def stream_landed_bars(spark: SparkSession, landing: str, *, multiline: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of a landing folder (explicit schema; ticker and copy from the file path).

    Pass the folder itself, not a glob: new files and new Hive-style subfolders under it are
    discovered on every trigger (a glob over partition folders is not supported by the file
    stream source together with file metadata).
    """
    reader = spark.readStream.schema(LANDED_SCHEMA).option("multiLine", multiline)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    raw = reader.json(landing).withColumn("source", F.col("_metadata.file_path"))
    return normalize_landed(raw)


def clean_enriched_stream(bars: DataFrame, profile: str = "strict", *, returns: bool = True) -> DataFrame:
    """Stateless per-bar part of the plan: the batch operators, applied to each micro-batch."""
    return enrich(filter_outliers(bars, profile), returns=returns)


def yearly_stream(enriched: DataFrame, *, exact: bool = True) -> DataFrame:
    """Running yearly means per (year, ticker); state is one row per key."""
    return enriched.groupBy("year", "ticker").agg(
        mean("close", exact=exact).alias("avg_close"),
        mean("intra_day_volatility", exact=exact).alias("avg_volatility"),
    )


def start_clean_sink(enriched: DataFrame, path: str, checkpoint: str | None = None, *, available_now: bool = True) -> StreamingQuery:
    """Append the enriched bars to Parquet partitioned by year."""
    spark = enriched.sparkSession
    checkpoint = checkpoint or scratch_path(spark, "stream-clean-ckpt")
    w = enriched.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).partitionBy("year")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.outputMode("append").start()


def start_yearly_sink(yearly: DataFrame, path: str, checkpoint: str | None = None, *, available_now: bool = True) -> StreamingQuery:
    """Maintain the yearly means below ``path``: the complete result of each batch in a folder of its
    own, then the batch's number in a table of finished batches. Read them with ``read_yearly``."""
    spark = yearly.sparkSession
    checkpoint = checkpoint or scratch_path(spark, "stream-yearly-ckpt")

    def write_batch(batch: DataFrame, epoch: int) -> None:
        # A batch that runs again after a failure writes the same folders again.
        batch.write.mode("overwrite").parquet(f"{path}/means/batch={epoch}")
        batch.sparkSession.range(1).select(F.lit(epoch).alias("finished")).write.mode("overwrite").parquet(f"{path}/finished/batch={epoch}")

    w = yearly.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(write_batch)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def read_yearly(spark: SparkSession, path: str) -> DataFrame:
    """The yearly means of the last finished batch; a batch under way is not seen."""
    last = spark.read.parquet(f"{path}/finished").agg(F.max("finished")).first()[0]
    return spark.read.parquet(f"{path}/means/batch={last}")


def run_available(spark: SparkSession, landing: str, out_dir: str, *, multiline: bool = False, profile: str = "strict") -> DataFrame:
    """Process everything currently in ``landing`` (``availableNow``) and return the yearly table.

    The landing is read by one stream; the yearly means are made from the clean table, so both
    always agree. They go to a new folder below ``yearly`` in each run: readers of an earlier one
    keep a whole table.
    """
    enriched = clean_enriched_stream(stream_landed_bars(spark, landing, multiline=multiline), profile)
    start_clean_sink(enriched, f"{out_dir}/clean", f"{out_dir}/_ckpt_clean").awaitTermination()
    clean = spark.read.schema(enriched.schema).parquet(f"{out_dir}/clean")
    path = f"{out_dir}/yearly/run={uuid.uuid4().hex}"
    yearly_stream(clean).write.parquet(path)
    return spark.read.parquet(path)


def run_new(spark: SparkSession, landing: str, out_dir: str, *, multiline: bool = False, profile: str = "strict") -> DataFrame | None:
    """Take in what has landed since the last run and return the yearly means of all runs.

    Each batch's clean bars go to a folder of their own below ``clean``, and their partial sums into the versions
    below ``yearly`` (``plans.incremental``): bars of earlier runs are not read again, and a batch that is replayed
    after a failure writes the same folder and counts once. None if nothing has ever landed.
    """
    enriched = clean_enriched_stream(stream_landed_bars(spark, landing, multiline=multiline), profile)

    def take_in(batch: DataFrame, epoch: int) -> None:
        path = f"{out_dir}/clean/batch={epoch}"
        batch.write.mode("overwrite").parquet(path)
        absorb(batch.sparkSession.read.schema(batch.schema).parquet(path), f"{out_dir}/yearly", f"batch {epoch}")

    query = enriched.writeStream.option("checkpointLocation", f"{out_dir}/_ckpt_new").foreachBatch(take_in).trigger(availableNow=True).start()
    query.awaitTermination()
    return yearly_means(spark, f"{out_dir}/yearly")
