"""Data multiplication with reproducible noise.

Each bar becomes ``copies + 1`` rows through ``explode(sequence(0, copies))`` — a generator, no
join and no Python worker. Copy 0 is the untouched original; copies 1..N get independent
multiplicative noise per field, a pure function of (ticker, date, copy, field, seed), so a re-run
(or a recomputed task after an executor loss) produces exactly the same rows.

Cost: the one string hash (SHA-256 of ticker|date|seed -> one 32-bit word per field) is taken
per *bar*, before the explode; each copy then derives its draws with a few integer operations
(``mix32``), so the per-output-row work is integer arithmetic inside whole-stage codegen.

Partitioning: the output is ``copies + 1`` times the input, and a small input (the original
landing) often arrives in very few partitions. So the copies are generated in two stages: each bar
becomes one row for each range of ``RANGE_COPIES`` copies, these rows are dealt out by (ticker,
date, range) over all cores, and the copies of a range are made where it lies. The shuffle moves one
row for each range and not for each copy, one bar's copies are made by many tasks, and a ticker
holding a third of the rows is spread by the date and the range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barframe.functions.expressions import bar_hash_words, mix_final, mix_round, mix_start, noise_factor
from barframe.operators.spread import spread

# Noise amplitudes and the number of copies of the large data set.
PRICE_NOISE = 0.02  # prices times 1 + U(-0.02, 0.02)
VOLUME_NOISE = 0.05  # volume times 1 + U(-0.05, 0.05)
DEFAULT_COPIES = 500
NOISE_SLOTS = {"open": 0, "high": 1, "low": 2, "close": 3, "volume": 4}
#: Copies that one row of the first stage stands for.
RANGE_COPIES = 32
_WORD = "_noise_w{}"


def _explode_copies(df: DataFrame, copies: int, include_original: bool, partitions: int | None, range_copies: int) -> DataFrame:
    first, last = 0 if include_original else 1, int(copies)
    if last < first:
        return df.select("*", F.lit(0).alias("copy_id")).limit(0)
    begins = F.explode(F.sequence(F.lit(first), F.lit(last), F.lit(int(range_copies)))).alias("_range")
    keys = [c for c in ("ticker", "date") if c in df.columns]
    ranges = spread(df.select("*", begins), *keys, "_range", partitions=partitions)
    copy = F.explode(F.sequence(F.col("_range"), F.least(F.col("_range") + int(range_copies) - 1, F.lit(last)))).alias("copy_id")
    return ranges.select(*df.columns, copy)


def with_noise_words(df: DataFrame, seed: int) -> DataFrame:
    """Attach the per-bar hash words (one per field) the noise is derived from."""
    words = bar_hash_words("ticker", "date", seed, len(NOISE_SLOTS))
    return df.withColumns({_WORD.format(k): w for k, w in enumerate(words)})


def replicate(
    df: DataFrame, copies: int, *, include_original: bool = True, partitions: int | None = None, range_copies: int = RANGE_COPIES
) -> DataFrame:
    """``copy_id`` 0..copies (or 1..copies) for every row.

    ``partitions``: over how many the ranges of copies are dealt (see ``spread``).
    """
    return _explode_copies(df, copies, include_original, partitions, range_copies)


def add_noise(df: DataFrame, seed: int = 42, *, price_noise: float = PRICE_NOISE, volume_noise: float = VOLUME_NOISE) -> DataFrame:
    """Multiply each present price/volume column of a frame with ``copy_id`` by its own noise
    factor (R2, R3, R5). Columns that are absent are skipped; NULL values stay NULL.

    Uses the hash words attached by ``with_noise_words`` when present, else computes them here.
    """
    if _WORD.format(0) not in df.columns:
        df = with_noise_words(df, seed)
    present = {name: slot for name, slot in NOISE_SLOTS.items() if name in df.columns}
    # One projection per mixer stage: each stage reads the previous one twice, so the optimizer
    # keeps the stages apart and every value is computed once per row.
    u = {name: f"_noise_u{slot}" for name, slot in present.items()}
    df = df.withColumns({c: mix_start(_WORD.format(present[n]), "copy_id") for n, c in u.items()})
    df = df.withColumns({c: mix_round(c) for c in u.values()})
    df = df.withColumns({c: mix_round(c) for c in u.values()})
    df = df.withColumns({c: mix_final(c) for c in u.values()})
    cols = {}
    for name in present:
        amp = volume_noise if name == "volume" else price_noise
        cols[name] = F.col(name) * noise_factor(None, "copy_id", amp, uniform=u[name])
    out = df.withColumns(cols)
    return out.drop(*u.values(), *[_WORD.format(k) for k in range(len(NOISE_SLOTS))])


def multiply_bars(
    df: DataFrame, copies: int = DEFAULT_COPIES, seed: int = 42, *, include_original: bool = True, partitions: int | None = None,
    range_copies: int = RANGE_COPIES,
) -> DataFrame:
    """Original plus ``copies`` noisy copies of every bar, keyed by ``copy_id``.

    Plan: hash words per bar → explode to ranges → deal out → explode to copies → integer noise.
    """
    return add_noise(_explode_copies(with_noise_words(df, seed), copies, include_original, partitions, range_copies), seed)
