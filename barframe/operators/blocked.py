"""Window operators for series too long for one task: split by calendar block, add a halo.

A trailing window of at most ``H`` rows only needs, besides the rows of a block, the ``H`` rows
that precede the block in the same series. So each series is cut into blocks (calendar years by
default); every block receives a *halo* — copies of the last ``H`` rows before its first row,
taken from one or more earlier blocks — and the windows run over ``(series, block)`` partitions.
Core rows get exactly the values a whole-series window would give; halo rows are dropped.

Cost and bounds:

* the halo candidates are the last ``H`` rows of each block (a top-k per block);
* the block table (one row per series and block) holds with each block the later blocks that its
  rows can still reach (a bounded window, at most ``H`` of them; one for blocks of ``H`` rows or
  more), and a candidate is copied to exactly those that need it — never all pairs of a group;
* the block table is small and joins once, on equality keys;
* one extra shuffle compared with the whole-series window, in exchange for spreading a long
  series (a ticker holding a third of all rows) over one task per block.

The input is read by several branches (block table, candidates, core rows) that need different
columns, so Spark scans it once per branch. Feed it a materialized bar table (Parquet): the extra
branches are then column-pruned scans, not recomputations of an upstream aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barframe.operators.aggregate import series_keys
from barframe.operators.clean import drop_incomplete
from barframe.operators.indicators import FEATURES, indicators

# Fixed value: the longest look-back of the indicator frame (MA20 reads 19 earlier rows, RSI 14
# earlier differences, the 5-row change 5 rows), rounded up.
INDICATOR_HALO = 20

BLOCK = "_block"
CORE = "_core"


def block_of(block: str | Column = "year") -> Column:
    """Block id per row: ``'year'`` (calendar year), ``'month'`` (year*100+month), or any column."""
    if isinstance(block, Column):
        return block
    if block == "year":
        return F.year("date")
    if block == "month":
        return F.year("date") * F.lit(100) + F.month("date")
    raise ValueError("block must be 'year', 'month' or a Column")


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join on columns of one name in which NULL equals NULL; the columns come once."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    condition = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on]
    matched = condition[0]
    for c in condition[1:]:
        matched = matched & c
    return left.join(renamed, matched).drop(*[f"_r_{c}" for c in on])


def with_halo(df: DataFrame, halo: int, *, keys: Sequence[str] | None = None, block: str | Column = "year") -> DataFrame:
    """Core rows (``_core`` true, in their own ``_block``) plus halo rows (``_core`` false), where
    every block receives the ``halo`` rows that precede it in its series, ordered by ``date``.
    """
    keys = list(keys) if keys is not None else series_keys(df)
    cols = df.columns
    b = df.withColumn(BLOCK, block_of(block))

    # Block table: rows up to each block's end, and the later blocks fewer than `halo` rows away,
    # each with the rows before its begin.
    bt = b.groupBy(*keys, BLOCK).agg(F.count(F.lit(1)).alias("_n"))
    wbt = Window.partitionBy(*keys).orderBy(BLOCK)
    bt = bt.withColumn("_cum", F.sum("_n").over(wbt.rowsBetween(Window.unboundedPreceding, 0)))
    later = F.struct(F.col(BLOCK).alias("block"), (F.col("_cum") - F.col("_n")).alias("before"))
    bt = bt.withColumn("_later", F.collect_list(later).over(wbt.rowsBetween(1, halo)))
    bt = bt.withColumn("_later", F.filter("_later", lambda t: t["before"] - F.col("_cum") < halo))

    # Candidates: the last `halo` rows of each block (reverse rank 1 = last row). One serves a block
    # when fewer than `halo` rows lie between: (rank - 1) + the rows of the blocks strictly between.
    wrev = Window.partitionBy(*keys, BLOCK).orderBy(F.col("date").desc())
    cand = b.withColumn("_rr", F.row_number().over(wrev)).filter(F.col("_rr") <= halo)
    cand = null_safe_join(cand, bt.select(*keys, BLOCK, "_cum", "_later"), [*keys, BLOCK])
    served = F.filter("_later", lambda t: (F.col("_rr") - 1) + (t["before"] - F.col("_cum")) < halo)
    halo_rows = cand.withColumn("_target", F.explode(served)).select(*cols, F.col("_target.block").alias(BLOCK), F.lit(False).alias(CORE))
    core = b.withColumn(CORE, F.lit(True))
    return core.unionByName(halo_rows)


def indicators_blocked(
    df: DataFrame, *, keys: Sequence[str] | None = None, block: str | Column = "year", dropna: bool = True
) -> DataFrame:
    """The indicator frame (W10) computed per (series, block) with a halo; equal to ``indicators``."""
    keys = list(keys) if keys is not None else series_keys(df)
    h = with_halo(df, INDICATOR_HALO, keys=keys, block=block)
    out = indicators(h, dropna=False, keys=[*keys, BLOCK]).filter(F.col(CORE)).drop(CORE, BLOCK)
    return drop_incomplete(out, subset=FEATURES) if dropna else out


def _positions(df: DataFrame, keys: Sequence[str], block: str | Column) -> DataFrame:
    """0-based row position of every row in its series (``_pos``) without a whole-series window:
    rows of the earlier blocks (small block table) plus the rank inside the row's own block."""
    b = df.withColumn(BLOCK, block_of(block))
    bt = b.groupBy(*keys, BLOCK).agg(F.count(F.lit(1)).alias("_bn"))
    wbt = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, 0)
    bt = bt.withColumn("_pos0", F.sum("_bn").over(wbt) - F.col("_bn")).drop("_bn")
    ranked = b.withColumn("_lrn", F.row_number().over(Window.partitionBy(*keys, BLOCK).orderBy("date")))
    return null_safe_join(ranked, bt, [*keys, BLOCK]).withColumn("_pos", F.col("_pos0") + F.col("_lrn") - 1).drop("_pos0", "_lrn", BLOCK)


def model_frame_blocked(
    bars: DataFrame,
    target: str = "close",
    *,
    keys: Sequence[str] | None = None,
    block: str | Column = "year",
    with_arrays: bool = False,
    checkpoint: bool = True,
    fit_on: str = "all",
) -> DataFrame:
    """``model_frame`` for long series, with no window over a whole series.

    * indicators per (series, block) with a halo (``indicators_blocked``);
    * per-series count and min/max of the 12 features as a partial aggregate joined back on the
      series keys (one row per series on the small side: broadcast, or a skew-split shuffle join);
    * the scaled frame is checkpointed into the shared checkpoint folder (``checkpoint=True``),
      because the next steps read it from several branches;
    * global row positions from a small block table (rows in earlier blocks) plus the rank
      within the block; ``prev_target`` and the sequence history from a 1- or 60-row halo;
    * the chronological split from the position and the series count.

    ``fit_on='train'`` fits the scaling bounds on the rows before the first test label only; the
    row positions for that mask come from the same block table.

    Returns the same columns and values as ``model_frame(bars, target, fit_on=fit_on)``.
    """
    from barframe.operators.modeling import (
        MAX_SEQUENCE_LENGTH,
        SEQUENCE_RATIO,
        TEST_SIZE,
        VALIDATION_SPLIT,
        sequence_length,
    )
    from barframe.plans.workspace import cut_lineage

    keys = list(keys) if keys is not None else series_keys(bars)
    tgt = f"{target}_scaled"
    ind = indicators_blocked(bars, keys=keys, block=block)
    base_cols = ind.columns

    if fit_on == "all":
        stats = ind.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("_n"),
            *[F.min(c).alias(f"min_{c}") for c in FEATURES],
            *[F.max(c).alias(f"max_{c}") for c in FEATURES],
        )
    elif fit_on == "train":
        # Fit rows: positions below n - ceil(test_size * (n - L)), positions from a block table.
        counts = ind.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        pos = null_safe_join(_positions(ind, keys, block), counts, keys)
        cutoff = F.col("_n") - F.ceil((F.col("_n") - sequence_length(F.col("_n"), MAX_SEQUENCE_LENGTH, SEQUENCE_RATIO)) * F.lit(TEST_SIZE))
        fit = F.col("_pos") < cutoff
        stats = pos.groupBy(*keys).agg(
            F.first("_n").alias("_n"),
            *[F.min(F.when(fit, F.col(c))).alias(f"min_{c}") for c in FEATURES],
            *[F.max(F.when(fit, F.col(c))).alias(f"max_{c}") for c in FEATURES],
        )
    else:
        raise ValueError("fit_on must be 'all' or 'train'")
    scaled = null_safe_join(ind, stats, keys)
    scaled = scaled.withColumns(
        {
            f"{c}_scaled": F.when(F.col(f"max_{c}") > F.col(f"min_{c}"), (F.col(c) - F.col(f"min_{c}")) / (F.col(f"max_{c}") - F.col(f"min_{c}"))).otherwise(F.lit(0.0))
            for c in FEATURES
        }
    )
    scaled = scaled.drop(*[f"{b}_{c}" for c in FEATURES if c != target for b in ("min", "max")])
    if checkpoint:
        scaled = cut_lineage(scaled)

    # Rows of the earlier blocks of each series (small table).
    bt = scaled.withColumn(BLOCK, block_of(block)).groupBy(*keys, BLOCK).agg(F.count(F.lit(1)).alias("_bn"))
    wbt = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, 0)
    bt = bt.withColumn("_pos0", F.sum("_bn").over(wbt) - F.col("_bn")).drop("_bn")

    halo = MAX_SEQUENCE_LENGTH if with_arrays else 1
    h = with_halo(scaled, halo, keys=keys, block=block)
    w = Window.partitionBy(*keys, BLOCK).orderBy("date")
    cols = {
        "prev_target": F.lag(tgt, 1).over(w),
        "_rn": F.row_number().over(w),
        "_nh": F.count(F.when(~F.col(CORE), F.lit(1))).over(Window.partitionBy(*keys, BLOCK)),
    }
    if with_arrays:
        step = F.array(*[F.col(f"{c}_scaled").cast("double") for c in FEATURES])
        cols["_hist"] = F.collect_list(step).over(w.rowsBetween(-MAX_SEQUENCE_LENGTH, -1))
    out = h.withColumns(cols).filter(F.col(CORE))
    out = null_safe_join(out, bt, [*keys, BLOCK])
    out = out.withColumns(
        {
            "seq_len": sequence_length(F.col("_n"), MAX_SEQUENCE_LENGTH, SEQUENCE_RATIO),
            "pos": (F.col("_pos0") + F.col("_rn") - F.col("_nh") - 1).cast("int"),
        }
    )
    if with_arrays:
        out = out.withColumn("sequence", F.slice("_hist", F.size("_hist") - F.col("seq_len") + 1, F.col("seq_len")))
    out = out.withColumn("label", F.col(tgt)).filter((F.col("seq_len") >= 1) & (F.col("pos") >= F.col("seq_len")))

    m = F.col("_n") - F.col("seq_len")
    k = F.col("pos") - F.col("seq_len") + 1
    n_test = F.ceil(m * F.lit(float(TEST_SIZE)))
    n_rest = m - n_test
    n_train = F.floor(n_rest * F.lit(float(1.0 - VALIDATION_SPLIT)))
    split = F.when(k > n_rest, F.lit("test")).when(k > n_train, F.lit("validation")).otherwise(F.lit("train"))
    out = out.withColumn("split", split)

    scaled_cols = [f"{c}_scaled" for c in FEATURES]
    order = [*base_cols, f"min_{target}", f"max_{target}", *scaled_cols, "seq_len", "pos", "prev_target"]
    if with_arrays:
        order.append("sequence")
    return out.select(*order, "label", "split")


def indicators_between(df: DataFrame, start, end=None, *, keys: Sequence[str] | None = None) -> DataFrame:
    """The indicator frame (W10) for rows with ``start <= date < end`` only, equal to the full frame
    filtered afterwards.

    Date predicates cannot be pushed below the windows (they would change rolling values), so the
    range is applied *before* them, with the last ``INDICATOR_HALO`` earlier rows of every series as
    a warm-up: a top-k per series, which each task cuts to that many rows before the shuffle. The
    earlier history is scanned, but neither shuffled nor sorted whole. Rows without a date come
    before all others.
    """
    keys = list(keys) if keys is not None else series_keys(df)
    s = F.lit(start).cast("date")
    within = F.col("date") >= s
    if end is not None:
        within = within & (F.col("date") < F.lit(end).cast("date"))
    latest = Window.partitionBy(*keys).orderBy(F.col("date").desc())
    earlier = df.filter((F.col("date") < s) | F.col("date").isNull())
    warm = earlier.withColumn("_rk", F.row_number().over(latest)).filter(F.col("_rk") <= INDICATOR_HALO).drop("_rk")
    frame = indicators(df.filter(within).unionByName(warm), dropna=False, keys=keys).filter(F.col("date") >= s)
    return drop_incomplete(frame, subset=FEATURES)
