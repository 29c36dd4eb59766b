"""More queries of the catalog: landings whose records differ in their fields. Importing the module registers them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barframe.operators.multiply import replicate
from barframe.plans.catalog import register, with_bars
from barframe.plans.workspace import scratch_path
from barframe.sources.fixtures import bars_lineitem
from barframe.sources.merge import field_report, merge_landings, merged_bars, variant_records
from barframe.sources.writers import landed_records


def _uneven_landing(spark, sf: str) -> str:
    """Three copies of the lineitem bars, in a folder each: the first with the six fields, the second with dividends
    and a number as note, the third with whole dividends, a text as note, and closes that are no numbers."""
    path = scratch_path(spark, "uneven")
    rows = landed_records(replicate(bars_lineitem(spark, sf), 2)).withColumn("day", F.substring("Date", 9, 2).cast("int"))
    plain = [F.col(c) for c in ("Date", "Open", "High", "Low", "Close", "Volume")]
    second = F.to_json(F.struct(*plain, (F.col("day") * F.lit(0.25)).alias("Dividends"), F.col("day").alias("Note")))
    close = F.when(F.col("day") == 13, F.lit('"n/a"')).otherwise(F.to_json(F.array("Close")).substr(F.lit(2), F.length(F.to_json(F.array("Close"))) - 2))
    others = F.to_json(F.struct(*[c for c in plain if c is not plain[4]], F.col("day").alias("Dividends"), F.concat(F.lit("n"), "day").alias("Note")))
    third = F.concat(F.lit('{"Close":'), close, F.lit(","), F.expr("substring(others, 2)"))
    rows = rows.withColumn("others", others)
    value = F.when(F.col("copy_id") == 0, F.to_json(F.struct(*plain))).when(F.col("copy_id") == 1, second).otherwise(third)
    rows.select("ticker", "copy_id", value.alias("value")).hint("rebalance", "ticker", "copy_id").write.partitionBy("ticker", "copy_id").text(path)
    return path


@register(
    "merged_schema",
    with_bars(
        "lineitem",
        """SELECT ticker, copy_id, date, open, CASE WHEN copy_id < 2 OR day(date) <> 13 THEN close END AS close, volume,
  CASE copy_id WHEN 1 THEN day(date) * 0.25::DOUBLE WHEN 2 THEN CAST(day(date) AS DOUBLE) END AS dividends,
  CASE copy_id WHEN 1 THEN CAST(day(date) AS VARCHAR) WHEN 2 THEN 'n' || day(date) END AS note,
  CASE WHEN copy_id = 2 AND day(date) = 13 THEN '{"Close":"n/a"}' END AS rescued
FROM bars, (SELECT CAST(unnest(range(3)) AS INTEGER) AS copy_id)""",
    ),
)
def q_merged_schema(spark, sf) -> DataFrame:
    """Copies with different fields, merged into one landing and read by the merged schema."""
    out = scratch_path(spark, "merged-schema")
    merge_landings(spark, _uneven_landing(spark, sf), out)
    return merged_bars(variant_records(spark, out)).select("ticker", "copy_id", "date", "open", "close", "volume", "dividends", "note", "rescued")


@register(
    "merged_schema_fields",
    with_bars(
        "lineitem",
        """SELECT field, names, CAST(n AS BIGINT) AS n_records, kinds, merged, conflict FROM (SELECT count(*) AS bars FROM bars), LATERAL (VALUES
  ('date', 'Date', 3 * bars, 'string', 'string', false), ('open', 'Open', 3 * bars, 'double', 'double', false),
  ('high', 'High', 3 * bars, 'double', 'double', false), ('low', 'Low', 3 * bars, 'double', 'double', false),
  ('close', 'Close', 3 * bars, 'double,string', 'string', true), ('volume', 'Volume', 3 * bars, 'double', 'double', false),
  ('dividends', 'Dividends', 2 * bars, 'bigint,double', 'double', false), ('note', 'Note', 2 * bars, 'bigint,string', 'string', true)
) v(field, names, n, kinds, merged, conflict)""",
    ),
)
def q_merged_schema_fields(spark, sf) -> DataFrame:
    """The fields of all records, their kinds, the merged type, and which are in conflict."""
    report = field_report(variant_records(spark, _uneven_landing(spark, sf)))
    return report.select("field", F.concat_ws(",", "names").alias("names"), "n_records", F.concat_ws(",", "kinds").alias("kinds"), "merged", "conflict")
