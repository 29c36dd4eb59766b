"""Large JSON arrays read by several tasks.

A file that holds one JSON array has no line ends to split at. It is read as text that ends at ``}`` instead, which
Spark splits by byte ranges like any text, and each piece is judged by the state of a JSON scanner at its start: inside a
string or not, and how many braces are open. That state is a prefix scan: a piece is summarised for both ways it
may begin, sums within a split come from one window over its pieces, and sums over splits from a table with a row
a split. A piece that begins and ends outside all braces is a record; the others are joined to records in order. So
braces in strings and nested objects cut nothing, and no task holds more than a split or one record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barframe.plans.workspace import scratch_path
from barframe.schema import LANDED_SCHEMA
from barframe.sources.readers import normalize_landed

_PIECE = "source string, size bigint, block bigint, place bigint, piece string, quotes int, inner int, depth_0 bigint, depth_1 bigint, delta_0 int, delta_1 int"


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Every piece with its place and what it does to a scanner that enters it outside (0) or inside (1) of a string."""
    text = spark.read.option("lineSep", "}").option("recursiveFileLookup", True).text(path)
    rows = text.select(
        F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"), F.col("value").alias("piece"),
    )
    plain = F.regexp_replace("piece", r"(?s)\\.", "")  # an escaped quote ends no string
    rows = rows.withColumn("_parts", F.split(plain, '"', -1))
    rows = rows.withColumn("quotes", ((F.size("_parts") - 1) % 2).cast("int"))

    def delta(start: int):
        outside = F.filter("_parts", lambda _p, i: i % 2 == start)
        opened = F.aggregate(outside, F.lit(0), lambda acc, p: acc + F.length(p) - F.length(F.replace(p, F.lit("{"), F.lit(""))))
        return opened - F.when((F.col("quotes") + start) % 2 == 0, 1).otherwise(0)

    return rows.withColumns({"delta_0": delta(0).cast("int"), "delta_1": delta(1).cast("int")}).drop("_parts")


def _within_splits(pieces: DataFrame) -> DataFrame:
    """With ``inner`` (in a string at the piece's start, if the split begins outside) and ``depth_s``, the braces opened in
    the split before the piece if the split begins in state s."""
    before = Window.partitionBy("source", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    rows = pieces.withColumn("inner", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).cast("int"))
    same, other = F.when(F.col("inner") == 0, F.col("delta_0")).otherwise(F.col("delta_1")), F.when(F.col("inner") == 0, F.col("delta_1")).otherwise(F.col("delta_0"))
    rows = rows.withColumns({"_same": same, "_other": other})
    depth = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0)).cast("bigint")
    rows = rows.withColumns({"depth_0": depth("_same"), "depth_1": depth("_other")})
    return rows.select(*[f.split()[0] for f in _PIECE.split(", ")])


def array_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``source, record``: the text of every object of the JSON arrays in the files below ``path``.

    The elements of an array must be objects (a null or a number between them is left out); a file may hold one object in
    place of an array, or arrays one after the other. Of a file that ends within a record, that record is left out, and what a
    file holds besides valid JSON may end up in a record's text, whose reader finds it malformed. The pieces are
    dealt out by split once and written to the shared work folder. A compressed file is one split.
    """
    out = scratch_path(spark, "array-pieces")
    _within_splits(_pieces(spark, path)).write.parquet(out)
    pieces = spark.read.schema(_PIECE).parquet(out)
    last = lambda c: F.max_by(c, "place")
    end = lambda s: F.col(f"depth_{s}") + F.when(F.col("inner") == s, F.col("delta_0")).otherwise(F.col("delta_1"))
    splits = pieces.groupBy("source", "block").agg(
        (F.sum("quotes") % 2).alias("quotes"), last(end(0)).alias("sum_0"), last(end(1)).alias("sum_1"),
        F.sum(F.octet_length("piece") + 1).alias("_bytes"), F.max("size").alias("_size"), F.max("place").alias("_place"),
    )
    # The tables of splits are small: a row for each byte range that a scan deals out.
    earlier = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("state", (F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2).cast("int"))
    gain = F.when(F.col("state") == 0, F.col("sum_0")).otherwise(F.col("sum_1"))
    splits = splits.withColumn("_gain", gain).withColumn("base", F.coalesce(F.sum("_gain").over(earlier), F.lit(0)))
    # With a closing brace for each piece, a file whose last piece has none comes out a byte too long.
    whole_file = Window.partitionBy("source")
    without = (F.sum("_bytes").over(whole_file) > F.col("_size")) & (F.col("block") == F.max("block").over(whole_file))
    splits = splits.withColumn("cut_off", F.when(without, F.col("_place")))
    rows = pieces.join(splits.select("source", "block", "state", "base", "cut_off"), ["source", "block"])
    inside = (F.col("state") + F.col("inner")) % 2
    depth = F.col("base") + F.when(F.col("state") == 0, F.col("depth_0")).otherwise(F.col("depth_1"))
    rows = rows.withColumns({"inside": inside, "depth": depth})
    rows = rows.withColumn("after", F.col("depth") + F.when(F.col("inside") == 0, F.col("delta_0")).otherwise(F.col("delta_1")))
    starts = (F.col("depth") <= 0) & (F.col("inside") == 0)
    ends = (F.col("after") <= 0) & ((F.col("inside") + F.col("quotes")) % 2 == 0) & ~F.col("place").eqNullSafe(F.col("cut_off"))
    whole = rows.where(starts & ends).select("source", "piece")
    # A record of several pieces is known by how many of these have begun before, in its split and in the splits before.
    parts = rows.where(~(starts & ends)).withColumn("_begins", starts.cast("int"))
    counts = parts.groupBy("source", "block").agg(F.sum("_begins").alias("n"))
    counts = counts.withColumn("offset", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    upto = Window.partitionBy("source", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = parts.withColumn("_number", F.sum("_begins").over(upto)).join(counts, ["source", "block"])
    joined = numbered.groupBy("source", (F.col("offset") + F.col("_number")).alias("number")).agg(
        F.array_sort(F.collect_list(F.struct("block", "place", "piece", ends.alias("ended")))).alias("p")
    )
    complete = joined.where(F.element_at("p", -1)["ended"]).select("source", F.array_join(F.col("p.piece"), "}").alias("piece"))
    text = F.concat(F.regexp_replace("piece", r"^[^{]*", ""), F.lit("}"))
    return whole.unionByName(complete).where(F.contains("piece", F.lit("{"))).select("source", text.alias("record"))


def read_array_bars(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Bars of JSON arrays as ``read_bars_json(multiline=True)`` gives them, however large a file is.

    A record that cannot be read gives a row without values, where the whole-file reader gives one for its file.
    """
    parsed = F.from_json("record", LANDED_SCHEMA)
    return normalize_landed(array_records(spark, path).select("source", parsed.alias("r")).select("source", "r.*"), records_first=True)
