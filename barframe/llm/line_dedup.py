"""Cross-site line dedup (JVM expressions only).

A line is boilerplate when it occurs on ``min_sites`` distinct sites or more. One aggregation
merges a HyperLogLog sketch of the sites per line key. Lines whose estimate is clearly below the
threshold stay, clearly above go, and those within ``band`` of it get exact distinct counts.
Of every boilerplate line the first occurrence (smallest document id, then position) stays, so
no content is lost altogether; all others are removed.

Lines are compared without surrounding spaces, tabs and carriage returns; blank lines are never
removed. A line is known by two independent 64-bit hashes.

Edge cases: a NULL text has no lines and stays NULL; the empty text is one blank line; a NULL
site counts for no site; rows of one document id (all NULL ids are one, before all others) are told
apart by a hash of their text, each cleaned by its own lines, the smallest hash first; equal
rows share their positions, so a first occurrence stays in each of them; an empty table gives an empty result. Further columns
pass through under their own names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barframe.plans.workspace import scratch_path

MIN_SITES = 10
LG_K = 12
#: Relative width of the band around the threshold; the sketch's error is 1.04 / sqrt(2**LG_K), 1.6 %.
BAND = 0.1


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_occurrences(df: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """``id, mark, site, pos, h1, h2`` of every line that is not blank; ``mark`` is a hash of the row's text."""
    exploded = df.select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("mark"), F.col(site_col).alias("site"), F.posexplode(_lines(F.col(text_col))).alias("pos", "line")
    ).withColumn("line", F.btrim("line", F.lit(" \t\r")))
    return exploded.where(F.col("line") != "").select(
        "id", "mark", "site", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2")
    )


def boilerplate_lines(occurrences: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K, band: float = BAND) -> DataFrame:
    """``h1, h2, first_id, first_pos, first_mark`` of the lines on at least ``min_sites`` distinct sites."""
    spark = occurrences.sparkSession
    sketched = (
        occurrences.groupBy("h1", "h2")
        .agg(
            F.hll_sketch_agg(F.col("site").cast("string"), F.lit(lg_k)).alias("sketch"),
            F.min(F.struct("id", "pos", "mark")).alias("first"),
        )
        .select("h1", "h2", "first", F.hll_sketch_estimate("sketch").alias("sites"))
        .where(F.col("sites") >= min_sites * (1 - band) - 1)
    )
    path = scratch_path(spark, "line-sketches")
    sketched.write.parquet(path)
    sketched = spark.read.parquet(path)
    high = min_sites * (1 + band) + 1
    near = sketched.where(F.col("sites") <= high)
    exact = (
        occurrences.join(near.select("h1", "h2"), ["h1", "h2"], "left_semi")
        .where(F.col("site").isNotNull())
        .select("h1", "h2", "site").distinct()
        .groupBy("h1", "h2").count()
        .where(F.col("count") >= min_sites)
    )
    sure = sketched.where(F.col("sites") > high)
    chosen = sure.unionByName(near.join(exact.select("h1", "h2"), ["h1", "h2"], "left_semi"))
    out = scratch_path(spark, "boilerplate-lines")
    first = [F.col(f"first.{c}").alias(f"first_{c}") for c in ("id", "pos", "mark")]
    chosen.select("h1", "h2", *first).write.parquet(out)
    # Read again with its size known: Spark broadcasts it only below its own threshold.
    return spark.read.parquet(out)


def dedup_lines(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
    min_sites: int = MIN_SITES, lg_k: int = LG_K, band: float = BAND,
) -> DataFrame:
    """The input with ``text_col`` cleaned, plus ``n_lines`` and ``n_removed_lines`` (replaced if present)."""
    occurrences = line_occurrences(df, id_col, text_col, site_col)
    known = boilerplate_lines(occurrences, min_sites, lg_k, band)
    removed = (
        occurrences.select("id", "mark", "pos", "h1", "h2").join(known, ["h1", "h2"])
        .where(~(F.col("id").eqNullSafe(F.col("first_id")) & (F.col("pos") == F.col("first_pos")) & (F.col("mark") == F.col("first_mark"))))
        .groupBy("id", "mark").agg(F.collect_set("pos").alias("gone"))
    )
    removed = removed.withColumnsRenamed({"id": "__gone_id", "mark": "__gone_mark"})
    joined = df.withColumns({"__id": F.col(id_col), "__mark": F.xxhash64(text_col), "__lines": _lines(F.col(text_col))}).join(
        removed, F.col("__id").eqNullSafe(F.col("__gone_id")) & (F.col("__mark") == F.col("__gone_mark")), "left"
    )
    # array_except works by a hash set, so a text of many lines costs time in proportion to them.
    kept = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("gone"))
    cleaned = F.when(F.col("gone").isNull(), F.col(text_col)).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(F.col("__lines"), i)), "\n")
    )
    n_lines = F.when(F.col(text_col).isNull(), F.lit(0)).otherwise(F.size("__lines"))
    n_removed = F.coalesce(F.size("gone"), F.lit(0))
    keep = [
        (cleaned if c == text_col else F.col(f"`{c}`")).alias(c)
        for c in df.columns if c not in ("n_lines", "n_removed_lines")
    ]
    return joined.select(
        *keep, n_lines.cast("long").alias("n_lines"), n_removed.cast("long").alias("n_removed_lines")
    )
