"""A store of training sequences (W11-W13): rows in blocks, each sequence an offset and a length into one.

Sliding sequences of up to 60 steps repeat every row up to 60 times. The store keeps the rows: each
series is cut by position into blocks of ``block_rows`` rows, and a block also holds the last
``max_len`` rows before it. As a block has at least ``max_len`` rows, those lie in the one before, so a
row is stored once or twice. The sequence of a label row is a slice of its block; slices are made only
when the store is read.

A block is bounded whatever the length of its series, so a series of any share of the rows is dealt
over many tasks, when packing and when reading.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barframe.operators.blocked import _positions, null_safe_join
from barframe.operators.indicators import series_window
from barframe.operators.modeling import MAX_SEQUENCE_LENGTH, SEQUENCE_RATIO, _keys, sequence_length
from barframe.operators.spread import spread

BLOCK_ROWS = 512


def pack_sequences(
    df: DataFrame, features: Sequence[str], target: str, *, keys=None, max_len: int = MAX_SEQUENCE_LENGTH, ratio: float = SEQUENCE_RATIO,
    block_rows: int = BLOCK_ROWS, block=None,
) -> DataFrame:
    """The sequences of ``make_sequences`` as blocks: ``keys, block, seq_len, first_pos, core_pos, dates, labels, steps``.

    ``steps`` holds the ``features`` of the block's rows from position ``first_pos`` on, the rows
    before ``core_pos`` being those of the block before; ``dates`` and ``labels`` run along. Series too
    short for a sequence have no blocks. Positions come from windows over whole series, or, with ``block`` (as
    for ``with_halo``, over a written table), from a table of calendar blocks.
    """
    if block_rows < max_len:
        raise ValueError("block_rows must be max_len or more")
    ks = _keys(df, keys)
    if block is None:
        whole = Window.partitionBy(*ks)
        placed = df.withColumns({"_n": F.count(F.lit(1)).over(whole), "_pos": F.row_number().over(series_window(df, ks)) - 1})
    else:
        counts = df.groupBy(*ks).agg(F.count(F.lit(1)).alias("_n"))
        placed = null_safe_join(_positions(df, ks, block), counts, ks)
    placed = placed.withColumns({"_pos": F.col("_pos").cast("int"), "_len": sequence_length(F.col("_n"), max_len, ratio)}).filter(F.col("_len") >= 1)
    own = F.floor(F.col("_pos") / block_rows).cast("int")
    again = (F.col("_pos") % block_rows >= block_rows - F.col("_len")) & ((own + 1) * block_rows < F.col("_n"))
    step = F.struct(
        F.col("_pos").alias("pos"), F.col("date").alias("date"), F.col(target).cast("double").alias("label"),
        F.array(*[F.col(c).cast("double") for c in features]).alias("step"),
    )
    dealt = placed.select(
        *ks, "_len", F.explode(F.when(again, F.array(own, own + 1)).otherwise(F.array(own))).alias("block"), step.alias("row")
    )
    blocks = dealt.groupBy(*ks, "block").agg(F.first("_len").alias("seq_len"), F.array_sort(F.collect_list("row")).alias("rows"))
    return blocks.select(
        *ks, "block", "seq_len", F.get("rows.pos", F.lit(0)).alias("first_pos"), (F.col("block") * block_rows).alias("core_pos"),
        F.col("rows.date").alias("dates"), F.col("rows.label").alias("labels"), F.col("rows.step").alias("steps"),
    )


def unpack_sequences(blocks: DataFrame, *, partitions: int | None = None) -> DataFrame:
    """One row for each sequence: ``keys, date, seq_len, pos, sequence, label``, as ``make_sequences`` has them.

    The blocks are dealt out first (over ``partitions``, see ``spread``), as what they unpack to is
    many times their size.
    """
    ks = [c for c in blocks.columns if c not in ("block", "seq_len", "first_pos", "core_pos", "dates", "labels", "steps")]
    length, first = F.col("seq_len"), F.col("first_pos")
    begin, end = F.greatest("core_pos", "seq_len"), first + F.size("steps") - 1
    items = F.transform(
        F.sequence(begin, end),
        lambda p: F.struct(
            F.get("dates", p - first).alias("date"), p.alias("pos"), F.slice("steps", p - length - first + 1, length).alias("sequence"),
            F.get("labels", p - first).alias("label"),
        ),
    )
    dealt = spread(blocks.where(begin <= end), *ks, "block", partitions=partitions)
    return dealt.select(*ks, "seq_len", F.explode(items).alias("s")).select(
        *ks, "s.date", "seq_len", "s.pos", "s.sequence", "s.label"
    )


def write_sequences(blocks: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """The store as Parquet."""
    blocks.write.mode(mode).parquet(path)


def read_sequences(spark: SparkSession, path: str) -> DataFrame:
    """The sequences of a written store."""
    return unpack_sequences(spark.read.parquet(path))
