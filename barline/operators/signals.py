"""Daily signals from the metrics of the same row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Thresholds on the 0..100 strength scale.
OVERBOUGHT, OVERSOLD = 70, 30

# Labels of each signal; the last is the default, also for NULL inputs.
TREND_LABELS = ("ABOVE_200MA", "BELOW_200MA")
RSI_LABELS = ("OVERBOUGHT", "OVERSOLD", "NEUTRAL")
MACD_LABELS = ("BULLISH", "BEARISH")
BAND_LABELS = ("ABOVE_UPPER_BAND", "BELOW_LOWER_BAND", "WITHIN_BANDS")

# Columns of the signals fact, in order.
SIGNAL_COLUMNS = (
    "symbol",
    "trade_date",
    "close",
    "ma_20",
    "ma_50",
    "ma_200",
    "rsi_14",
    "macd_approx",
    "macd_signal_approx",
    "bollinger_upper",
    "bollinger_lower",
    "volatility_annualized",
    "trend_signal",
    "rsi_signal",
    "macd_trend_signal",
    "bollinger_signal",
)


def _label(labels: tuple[str, ...], *conditions: Column) -> Column:
    """The label of the first condition that holds, else the last label."""
    first, *others = zip(conditions, labels)
    chosen = F.when(*first)
    for condition, label in others:
        chosen = chosen.when(condition, label)
    return chosen.otherwise(labels[-1])


def with_signals(df: DataFrame, overbought: float = OVERBOUGHT, oversold: float = OVERSOLD) -> DataFrame:
    """Classify each row by its own metrics."""
    close, rsi, line = F.col("close"), F.col("rsi_14"), F.col("macd_approx")
    return df.withColumns(
        {
            "trend_signal": _label(TREND_LABELS, close > F.col("ma_200")),
            "rsi_signal": _label(RSI_LABELS, rsi >= overbought, rsi <= oversold),
            "macd_trend_signal": _label(MACD_LABELS, line > F.col("macd_signal_approx")),
            "bollinger_signal": _label(
                BAND_LABELS, close > F.col("bollinger_upper"), close < F.col("bollinger_lower")
            ),
        }
    )


def trade_signals(
    metrics: DataFrame, overbought: float = OVERBOUGHT, oversold: float = OVERSOLD
) -> DataFrame:
    """The signals fact: one row per daily metrics row."""
    return with_signals(metrics, overbought, oversold).select(*SIGNAL_COLUMNS)
