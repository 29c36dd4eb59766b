"""More queries of the catalog: tables that outlive a run. Importing the module registers them."""

from __future__ import annotations

from pyspark.sql import functions as F

from barframe.operators.charts import chart_points
from barframe.operators.clean import filter_outliers
from barframe.operators.enrich import enrich
from barframe.operators.modeling import model_frame
from barframe.operators.multiply import multiply_bars
from barframe.operators.stored_models import score_bars, store_models
from barframe.plans.catalog import (
    BAR_COLS,
    COPIES_LARGE,
    SEED,
    SQL_AR1_FIT,
    SQL_BARS,
    SQL_STRICT,
    copy_sums,
    register,
    rounded,
    sql_copy_sums,
    sql_enrich,
    sql_exact_mean,
    sql_model_ctes,
    sql_multiply,
    sql_round,
    with_bars,
)
from barframe.plans.catalog_jobs import SQL_DIRTY, dirty_bars
from barframe.plans.incremental import absorb, yearly_means
from barframe.plans.workspace import scratch_path
from barframe.schema import schema_rows
from barframe.sources.arrays import read_array_bars
from barframe.sources.compact import compact_landing, read_compacted
from barframe.sources.fixtures import bars_events, bars_lineitem, bars_supplier
from barframe.sources.inventory import file_inventory, inventory_report
from barframe.sources.readers import file_report
from barframe.sources.versions import read_version, write_version
from barframe.sources.writers import landed_records, write_line_json, write_text
from barframe.streaming.ingest import run_new


@register("compacted_roundtrip", sql_copy_sums(sql_multiply("events", COPIES_LARGE)))
def q_compacted_roundtrip(spark, sf):
    """A file for each copy, packed into files near a target size; copies landed afterwards are read as they are."""
    base = scratch_path(spark, "compacted")
    copies = multiply_bars(bars_events(spark, sf), COPIES_LARGE, SEED)
    later = F.col("copy_id") > COPIES_LARGE - 20
    write_line_json(copies.where(~later), f"{base}/landing/part=0", partition_by=["ticker", "copy_id"])
    compact_landing(spark, f"{base}/landing", f"{base}/store", target_bytes=4 << 20)
    write_line_json(copies.where(later), f"{base}/landing/part=1", partition_by=["ticker", "copy_id"])
    return copy_sums(read_compacted(spark, f"{base}/landing", f"{base}/store"))


@register(
    "incremental_yearly",
    with_bars(
        "lineitem",
        f"""SELECT year, ticker, {sql_exact_mean('close')} AS avg_close, {sql_exact_mean('intra_day_volatility')} AS avg_volatility,
  {sql_round('avg((high - low) / nullif(open, 0) * 100)')} AS avg_raw_volatility FROM enr GROUP BY year, ticker""",
        f"clean AS (SELECT * FROM bars WHERE {SQL_STRICT})",
        f"enr AS ({sql_enrich('clean')})",
    ),
)
def q_incremental_yearly(spark, sf):
    """Three landings, each taken in by itself; the last batch is offered twice and counts once."""
    base = scratch_path(spark, "incremental")
    bars = bars_lineitem(spark, sf)
    for part in range(3):
        write_line_json(bars.where(F.dayofmonth("date") % 3 == part), f"{base}/landing/part={part}")
        run_new(spark, f"{base}/landing", f"{base}/out")
    absorb(enrich(filter_outliers(bars)), f"{base}/out/yearly", "batch 2")
    return rounded(yearly_means(spark, f"{base}/out/yearly"), {"avg_raw_volatility": 6})


@register("versioned_overwrite", SQL_BARS["supplier"])
def q_versioned_overwrite(spark, sf):
    """K1: bars overwritten by a later version, the one before read by its number, both put together."""
    path = scratch_path(spark, "versions")
    bars = bars_supplier(spark, sf).select(*BAR_COLS)
    late = F.year("date") >= 1995
    first = write_version(bars.where(late), path)
    write_version(bars.where(~late), path)
    return read_version(spark, path, first).unionByName(read_version(spark, path))


CHART_WIDTH = 200
_SPAN = "span AS (SELECT ticker, min(date) AS first, max(date) AS last FROM bars GROUP BY ticker)"


@register(
    "chart_points",
    with_bars(
        "lineitem",
        """SELECT DISTINCT ticker, pixel, p.date AS date, p.close AS close FROM (
  SELECT ticker, pixel, unnest([min({'date': date, 'close': close}), max({'date': date, 'close': close}),
    arg_min({'date': date, 'close': close}, (close, date)), arg_min({'date': date, 'close': close}, (-close, date))]) AS p
  FROM px GROUP BY ticker, pixel)""",
        _SPAN,
        f"""px AS (SELECT ticker, date, close, CAST(CASE WHEN date = last AND first < last THEN {CHART_WIDTH - 1}
  ELSE floor((date - first) * {CHART_WIDTH} / (last - first + 1)) END AS INTEGER) AS pixel FROM bars JOIN span USING (ticker))""",
    ),
)
def q_chart_points(spark, sf):
    """The close history as the points that a chart of 200 pixel columns needs."""
    return chart_points(bars_lineitem(spark, sf), width=CHART_WIDTH)


@register(
    "file_inventory",
    with_bars(
        "lineitem",
        """SELECT ticker, count(*) AS n_records, 'ok' AS status FROM bars GROUP BY ticker
UNION ALL SELECT 'EMPTY', 0, 'empty' UNION ALL SELECT DISTINCT event_type, 0, 'missing' FROM events""",
    ),
)
def q_file_inventory(spark, sf):
    """A landing with a file of zero bytes, which no scan sees, and expected files that never came."""
    path = scratch_path(spark, "inventory-landing")
    write_line_json(bars_lineitem(spark, sf), path)
    spark.range(0).select(F.lit("").alias("value")).coalesce(1).write.text(f"{path}/ticker=EMPTY")
    never = spark.read.parquet(f"{sf}/events.parquet").select(F.concat(F.lit("ticker="), "event_type", F.lit("/bars.json")).alias("path"))
    report = inventory_report(file_report(spark, path), file_inventory(spark, path), never)
    return report.groupBy("ticker").agg(F.sum("n_records").alias("n_records"), F.max("status").alias("status"))


MODEL_END = "1997-06-30"


@register(
    "stored_model_scores",
    f"WITH every AS ({SQL_BARS['supplier']}),\nbars AS (SELECT * FROM every WHERE date <= DATE '{MODEL_END}'),\n"
    + ",\n".join(
        [
            *sql_model_ctes(),
            SQL_AR1_FIT,
            """mo AS (SELECT ticker, slope, intercept, lo, hi, last_date, last_value FROM co JOIN (SELECT ticker, max(min_close) AS lo,
  max(max_close) AS hi, max(date) AS last_date, arg_max(close, date) AS last_value FROM fr GROUP BY ticker) USING (ticker))""",
            f"""nw AS (SELECT every.ticker, date, close, mo.* EXCLUDE (ticker), mo.ticker IS NOT NULL AS known,
  CASE WHEN row_number() OVER w = 1 THEN last_value ELSE lag(close) OVER w END AS before
FROM every LEFT JOIN mo ON every.ticker = mo.ticker WHERE date > DATE '{MODEL_END}' WINDOW w AS (PARTITION BY every.ticker ORDER BY date))""",
        ]
    )
    + f"""
SELECT ticker, date, close AS actual, {sql_round('(intercept + slope * CASE WHEN hi > lo THEN (before - lo) / (hi - lo) ELSE 0.0 END) * (hi - lo) + lo', 2)} AS predicted,
  before AS last_value, CASE WHEN NOT known THEN 'no model' WHEN slope IS NULL THEN 'no fit' WHEN before IS NULL THEN 'no value before' ELSE 'ok' END AS status FROM nw""",
)
def q_stored_model_scores(spark, sf):
    """M1, M2, M8: models of the bars up to a day, stored; the bars after it are scored without a refit."""
    path = scratch_path(spark, "models")
    bars = bars_supplier(spark, sf)
    end = F.lit(MODEL_END).cast("date")
    store_models(model_frame(bars.where(F.col("date") <= end), "close"), path)
    return rounded(score_bars(spark, bars.where(F.col("date") > end), path), {"predicted": 2})


_TYPES = {"ticker": "string", "date": "date"}


@register(
    "schema_report",
    with_bars(
        "lineitem",
        "\nUNION ALL\n".join(
            f"SELECT {i} AS position, '{c}' AS name, '{_TYPES.get(c, 'double')}' AS type, count(*) AS n_rows, count(*) - count({c}) AS n_null FROM db"
            for i, c in enumerate(BAR_COLS)
        ),
        SQL_DIRTY,
    ),
)
def q_schema_report(spark, sf):
    """K9: the columns of dirty bars, their types and how many values they lack."""
    return schema_rows(dirty_bars(spark, sf).select(*BAR_COLS)).drop("nullable")


@register("array_splits", SQL_BARS["lineitem"])
def q_array_splits(spark, sf):
    """JSON arrays of nested records with braces in their texts, read by byte ranges."""
    path = scratch_path(spark, "array-splits")
    note = F.struct(F.lit('}, {"').alias("text"), F.array(F.struct(F.lit("\\").alias("sign"))).alias("deep"))
    records = landed_records(bars_lineitem(spark, sf)).withColumn("Note", note)
    arrays = records.groupBy("ticker", F.substring("Date", 1, 4).alias("year")).agg(F.to_json(F.collect_list(F.struct("Date", "Note", "Open", "High", "Low", "Close", "Volume"))).alias("json"))
    write_text(arrays, path, "json", partition_by=["ticker"])
    return read_array_bars(spark, path).select(*BAR_COLS)
