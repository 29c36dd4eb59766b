"""Sharding by rendezvous hashing of a stable record key (JVM expressions only).

Every shard draws a number from the key; the highest weighted draw wins. A record's draw for a
shard does not depend on the other shards, so one more shard takes records into itself and moves
no record between the old ones.

Edge cases: a NULL key is a key of its own (all its records meet in one shard); a NULL text has
no bytes and the checksum of the empty text; repeated rows get separate slots; an empty table
gives an empty result. Only the named columns are read, so further columns never clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Slots are numbered within blocks of about so many records of a shard.
ROWS_PER_BLOCK = 200_000
_DRAW_RANGE = float(1 << 52)


def draw(key: Column, shard: Column) -> Column:
    """A number in (0, 1) that depends on the key and the shard only."""
    named = F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(":"), shard.cast("string"))
    return (F.conv(F.substring(F.md5(named.cast("binary")), 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(_DRAW_RANGE)


def score(key: Column, shard: Column, weight: Column) -> Column:
    """The weighted draw: shards win records in proportion to their weights."""
    return -weight / F.log(draw(key, shard))


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard (from 0) with the highest weighted draw; of equal draws, the lowest shard."""
    scores = [
        F.struct(score(key, F.lit(i), F.lit(float(w))).alias("score"), F.lit(-i).alias("shard"))
        for i, w in enumerate(weights)
    ]
    if not scores:
        raise ValueError("weights is empty")
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return (-best["shard"]).cast("int")


def assign_shards(df: DataFrame, key: str, text: str, weights: Sequence[float], grown_weight: float = 1.0) -> DataFrame:
    """``key, size, text_crc32, law, shard, slot, grown_shard`` for every record.

    ``slot`` numbers a shard's records from 0 without gaps. Shards are numbered in blocks (by a
    hash of the key), so that no task sorts a whole shard; ``grown_shard`` is the shard with one
    more shard of weight ``grown_weight``.
    """
    rows = df.select(
        F.col(key).alias("k"),
        (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + F.lit(8)).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    rows = rows.withColumn("shard", rendezvous(F.col("k"), weights))
    own_weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("shard") + 1)
    old = score(F.col("k"), F.col("shard"), own_weight)
    new = score(F.col("k"), F.lit(len(weights)), F.lit(float(grown_weight)))
    rows = rows.withColumn("grown_shard", F.when(new > old, F.lit(len(weights))).otherwise(F.col("shard")))

    # The row count sets the number of blocks; counting reads no text.
    blocks = df.select(key).count() // (ROWS_PER_BLOCK * len(weights)) + 16
    rows = rows.withColumn("block", F.pmod(F.xxhash64("k"), F.lit(blocks)).cast("int"))
    counts = rows.groupBy("shard", "block").count()
    by_block = Window.partitionBy("shard").orderBy("block")
    offsets = counts.select(
        "shard", "block", (F.sum("count").over(by_block) - F.col("count")).alias("before")
    )
    in_block = Window.partitionBy("shard", "block").orderBy("k", "text_crc32", "size")
    return (
        rows.withColumn("n", F.row_number().over(in_block))
        .join(offsets, ["shard", "block"])
        .select(
            F.col("k").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard",
            (F.col("before") + F.col("n") - 1).cast("long").alias("slot"),
            F.col("grown_shard").cast("int").alias("grown_shard"),
        )
    )
