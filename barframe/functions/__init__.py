"""Column expressions shared by the operators (all built-in Spark functions, codegen-friendly)."""

from barframe.functions.expressions import (  # noqa: F401
    bar_hash_words,
    copy_uniform,
    daily_return,
    day_of_week,
    full_window_mean,
    intra_day_volatility,
    mix32,
    noise_factor,
    noise_uniform,
    pct_change,
    safe_div,
    ticker_from_path,
    to_bar_date,
    to_bar_timestamp,
    volatility_ratio,
)
