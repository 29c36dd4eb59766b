"""DataFrame -> DataFrame operators."""

from barframe.operators.aggregate import (  # noqa: F401
    describe_bars,
    describe_before_after,
    distinct_sorted,
    series_keys,
    series_stats,
    yearly_summary,
)
from barframe.operators.blocked import indicators_between, indicators_blocked, model_frame_blocked, with_halo  # noqa: F401
from barframe.operators.charts import actual_vs_predicted, close_by_year, close_history, volatility_by_ticker  # noqa: F401
from barframe.operators.clean import (  # noqa: F401
    PROFILES,
    coverage_report,
    drop_incomplete,
    filter_outliers,
    missing_tickers,
    outlier_predicate,
    rejected_rows,
    restrict_dates,
    select_series,
)
from barframe.operators.enrich import add_volatility, enrich, tag_ticker  # noqa: F401
from barframe.operators.indicators import (  # noqa: F401
    FEATURES,
    add_moving_averages,
    add_price_changes,
    add_rsi,
    indicators,
    series_window,
)
from barframe.operators.modeling import (  # noqa: F401
    ar1_coefficients,
    ar1_predictions,
    chronological_split,
    evaluate,
    feature_forecast,
    fit_feature_regression,
    fit_lag_regression,
    forecast,
    future_dates,
    inverse_scale,
    last_rows,
    make_sequences,
    min_max_scale,
    model_frame,
    recursive_forecast,
)
from barframe.operators.multiply import add_noise, multiply_bars, replicate  # noqa: F401
from barframe.operators.union import union_by_name  # noqa: F401
