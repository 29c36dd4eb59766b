"""Connected components of a link table, by label propagation with shortcuts.

Links and labels stay in Spark tables; every round is written to the shared work folder, so a lost
executor repeats one round at most and plans stay short. The driver sees counts only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barframe.plans.workspace import scratch_path


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of ``src, dst``.

    Each round is a large-star and a small-star step (Kiveris et al. 2014): every node's neighbours
    are linked to the smallest of them, which keeps components and flattens them into stars.
    A node's neighbours are never gathered into one row. Links with a NULL end are left out.
    """
    spark = links.sparkSession

    def written(df: DataFrame) -> DataFrame:
        path = scratch_path(spark, "components")
        df.write.parquet(path)
        return spark.read.parquet(path)

    def star(edges: DataFrame, large: bool) -> DataFrame:
        """Large star: links of all neighbours above a node; small star: of those below and itself."""
        both = edges.select(F.col("u"), F.col("v"))
        if large:
            both = both.union(edges.select("v", "u"))
        else:
            both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        joined = both.join(low, "u")
        if large:
            out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        return out.where("u <> v").distinct()

    edges = links.select(F.col("src").alias("u"), F.col("dst").alias("v")).where("u <> v")
    edges = written(edges)
    nodes = edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct()
    before = None
    while True:
        edges = written(star(star(edges, True), False))
        # The sum over both ends falls with every change, so equal sums mean that nothing changed.
        now = edges.agg(
            F.count("*"), F.sum(F.col("u").cast("decimal(38,0)")), F.sum(F.col("v").cast("decimal(38,0)"))
        ).first()
        if now == before:
            break
        before = now
    return nodes.join(edges.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )
