"""Column -> Column helpers.

Everything here is a built-in Spark expression, so it stays inside whole-stage codegen.
Division is always ``try_divide``: Spark 4 runs in ANSI mode and a plain ``x / 0`` fails
the whole job, while the intended meaning of a zero base is "no value" (NULL).
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_div(num, den) -> Column:
    """``num / den`` with NULL for a zero (or NULL) denominator."""
    return F.try_divide(_c(num), _c(den))


# ---------------------------------------------------------------- dates and calendar


def to_bar_date(c) -> Column:
    """ISO string (``2000-01-03`` or ``2000-01-03T00:00:00.000``), timestamp or date -> date.

    Malformed strings become NULL instead of failing the job (ANSI cast would raise).
    """
    return _c(c).try_cast("date")


def to_bar_timestamp(c) -> Column:
    """ISO string or date -> timestamp (P5); malformed strings become NULL."""
    return _c(c).try_cast("timestamp")


def day_of_week(c) -> Column:
    """Day of week with 1 = Sunday ... 7 = Saturday (Spark's ``dayofweek``)."""
    return F.dayofweek(_c(c))


# ---------------------------------------------------------------- per-bar measures


def daily_return(open_="open", close="close", digits: int | None = 2) -> Column:
    """Open-to-close change in percent, ``(close - open) / open * 100``, rounded to ``digits``."""
    v = safe_div(_c(close) - _c(open_), _c(open_)) * F.lit(100.0)
    return F.round(v, digits) if digits is not None else v


def intra_day_volatility(high="high", low="low", open_="open", digits: int | None = 2) -> Column:
    """Intraday range in percent of the open, ``(high - low) / open * 100``; unrounded if ``digits`` is None."""
    v = safe_div(_c(high) - _c(low), _c(open_)) * F.lit(100.0)
    return F.round(v, digits) if digits is not None else v


def volatility_ratio(high="high", low="low", open_="open") -> Column:
    """Intraday range as a ratio of the open, ``(high - low) / open``."""
    return safe_div(_c(high) - _c(low), _c(open_))


# ---------------------------------------------------------------- window helpers


def pct_change(c, w: WindowSpec, periods: int = 1) -> Column:
    """Relative change against the value ``periods`` rows earlier: ``c / lag(c) - 1``.

    A zero or missing base gives NULL (never +-inf), so a later ``dropna`` removes the row.
    """
    return safe_div(_c(c), F.lag(_c(c), periods).over(w)) - F.lit(1.0)


def full_window_mean(c, w: WindowSpec, n: int) -> Column:
    """Trailing ``n``-row mean that is NULL until ``n`` non-null values are in the frame.

    This is the rolling-mean convention where a partial window has no value.
    """
    frame = w.rowsBetween(-(n - 1), Window.currentRow)
    return F.when(F.count(_c(c)).over(frame) == n, F.avg(_c(c)).over(frame))


# ---------------------------------------------------------------- lineage from paths

# The file-name conventions of the landed data.
#   <TICKER>.json            one JSON array per ticker
#   <TICKER>_<n>.json        noisy copy number n (a Spark output directory)
#   <TICKER>_original.json   unmodified copy
#   <TICKER>_merged.json     all copies of a ticker merged
#   ticker=<TICKER>/         Hive-style partition directory
_HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"
_HIVE_TICKER = r"/ticker=([^/]+)(?:/|$)"
_FILE_TICKER = r"/([^/]+?)(?:_(?:original|merged|[0-9]+))?\.json(?:/|$)"


def ticker_from_path(path_col) -> Column:
    """Ticker encoded in a file path: Hive ``ticker=`` directory first, else the first ``*.json`` segment.

    The ``.json`` segment may be a flat file or a Spark output directory (``AAPL_3.json/part-…``),
    so the match is taken at directory or file level, with copy suffixes stripped.
    """
    p = _c(path_col)
    hive = F.regexp_extract(p, _HIVE_TICKER, 1)
    named = F.regexp_extract(p, _FILE_TICKER, 1)
    # Scanned paths are URL-encoded; Spark's partition folders escape the value once more before.
    value = F.when(hive != _HIVE_NULL, _url_decoded(_url_decoded(hive)))
    return F.when(hive != "", value).when(named != "", _url_decoded(named))


def path_of_source(source) -> Column:
    """The path to read for a scanned file's ``source`` (which is URL-encoded), its glob characters escaped."""
    return F.regexp_replace(_url_decoded(_c(source)), r"([\[\]{}*?\\])", r"\\$1")


def _url_decoded(c: Column) -> Column:
    """Percent escapes resolved ('+' stays); a text with broken escapes stays as it is."""
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


# ---------------------------------------------------------------- reproducible noise

# Fixed values of the noise construction (changing any of them changes every generated copy).
_TWO_32 = 4294967296.0
_MASK32 = 0xFFFFFFFF
_GOLDEN = 0x9E3779B1  # copy-id stride (2654435761)
_MIX_MUL = 0x45D9F3B  # 32-bit mixer multiplier (73244475)
NOISE_WORDS = 5  # one word per field: open, high, low, close, volume


def bar_hash_words(ticker, date, seed: int, n: int = NOISE_WORDS) -> list[Column]:
    """``n`` independent 32-bit words (as BIGINT) from one SHA-256 of ``ticker|date|seed``.

    This is the only string hash of the noise; it depends on the bar, not on the copy, so it is
    computed once per bar before the bar is replicated.
    """
    if not 1 <= n <= 8:
        raise ValueError("n must be in 1..8")
    key = F.concat_ws("|", _c(ticker).cast("string"), _c(date).cast("string"), F.lit(str(seed)))
    digest = F.sha2(key, 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(n)]


def mix_start(word, copy_id) -> Column:
    """Mixer input for one (bar, field) word and one copy: ``(word + copy * stride) mod 2**32``."""
    return (_c(word) + _c(copy_id).cast("bigint") * F.lit(_GOLDEN)).bitwiseAND(F.lit(_MASK32))


def mix_round(x) -> Column:
    """One multiply/xor-shift round of the 32-bit mixer (products stay below 2**59: ANSI-safe)."""
    x = _c(x)
    return (F.shiftright(x, 16).bitwiseXOR(x) * F.lit(_MIX_MUL)).bitwiseAND(F.lit(_MASK32))


def mix_final(x) -> Column:
    """Last xor-shift of the mixer, scaled to a uniform [0, 1) draw."""
    x = _c(x)
    return F.shiftright(x, 16).bitwiseXOR(x) / F.lit(_TWO_32)


def mix32(x: Column) -> Column:
    """Avalanche a 32-bit value held in a BIGINT: two ``mix_round`` and a final xor-shift.

    As one expression the input appears eight times; on wide frames apply the rounds as separate
    projections (as ``add_noise`` does) so each round is evaluated once.
    """
    x = mix_round(mix_round(x))
    return F.shiftright(x, 16).bitwiseXOR(x)


def copy_uniform(word, copy_id) -> Column:
    """Uniform [0, 1) draw for one (bar, field) word and one copy: ``mix32(word + copy * stride) / 2**32``."""
    return mix32(mix_start(word, copy_id)) / F.lit(_TWO_32)


def noise_factor(word, copy_id, amplitude: float, *, uniform=None) -> Column:
    """Multiplicative noise ``1 + U(-amplitude, amplitude)``; exactly 1 for copy 0 (the original).

    ``uniform`` may pass an already computed draw (a column); otherwise it is derived from ``word``.
    """
    u = _c(uniform) if uniform is not None else copy_uniform(word, copy_id)
    factor = F.lit(1.0) + F.lit(float(amplitude)) * (F.lit(2.0) * u - F.lit(1.0))
    return F.when(_c(copy_id) == 0, F.lit(1.0)).otherwise(factor)


def noise_uniform(ticker, date, copy_id, seed: int, slot: int) -> Column:
    """The draw of field ``slot`` for (ticker, date, copy, seed), computed from scratch (no precomputed word)."""
    return copy_uniform(bar_hash_words(ticker, date, seed, slot + 1)[slot], copy_id)
