"""Calendar, return and volatility columns.

All derived columns are added in one ``select`` so the plan holds one ``Project``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barframe.functions.expressions import daily_return, day_of_week, intra_day_volatility, volatility_ratio


def tag_ticker(df: DataFrame, ticker: str) -> DataFrame:
    """Constant ticker column (P3), for a frame read from a single ticker's file."""
    return df.withColumn("ticker", F.lit(ticker))


def enrich(df: DataFrame, *, returns: bool = True, digits: int = 2) -> DataFrame:
    """Add ``year, month, day_of_week`` and, rounded to ``digits``, ``daily_return`` (open→close %)
    and ``intra_day_volatility`` ((high-low)/open %). ``returns=False`` gives the large-pipeline
    variant without ``daily_return``.
    """
    cols = {
        "year": F.year("date"),
        "month": F.month("date"),
        "day_of_week": day_of_week("date"),
    }
    if returns:
        cols["daily_return"] = daily_return(digits=digits)
    cols["intra_day_volatility"] = intra_day_volatility(digits=digits)
    return df.withColumns(cols)


def add_volatility(df: DataFrame) -> DataFrame:
    """Unrounded intraday volatility in percent (P11) and as a ratio."""
    return df.withColumns(
        {
            "volatility_pct": intra_day_volatility(digits=None),
            "volatility": volatility_ratio(),
        }
    )
