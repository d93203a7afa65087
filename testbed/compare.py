"""Rounding of the columns that may differ in their last binary digits between engines.

Fixture prices are whole numbers or halves of them, so their sums are exact and means, ratios
and differences come out the same everywhere: those columns are compared as they are. Square
roots, logarithms and sums of fractions depend on the library or on the order of adding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Column -> decimals kept.
DIGITS = dict.fromkeys(
    (
        "daily_log_return",
        "volatility_annualized",
        "avg_volatility",
        "stddev_20",
        "bollinger_upper",
        "bollinger_lower",
        "bolinger_up",
        "bolinger_down",
        "macd_signal_approx",
    ),
    6,
) | dict.fromkeys(
    # Prices of tens of thousands, folded: their last binary digit is worth 1e-11, so a sixth decimal would meet ties.
    ("ema_12", "ema_26", "macd_ema", "macd_ema_signal", "macd_ema_histogram"),
    3,
)


def comparable(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, DIGITS[c]) for c in df.columns if c in DIGITS})
