"""Narrow projections of the metrics for downstream readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def ma_projection(metrics: DataFrame) -> DataFrame:
    """Short and long moving average per day."""
    return metrics.select(
        F.col("trade_date").alias("date"),
        F.col("symbol").alias("ticker"),
        F.col("ma_20").alias("twenty_ma"),
        F.col("ma_200").alias("two_hundred_ma"),
    )


def band_projection(metrics: DataFrame) -> DataFrame:
    """Bands per ticker; the output names are fixed."""
    return metrics.select(
        F.col("symbol").alias("ticker"),
        F.col("bollinger_upper").alias("bolinger_up"),
        F.col("bollinger_lower").alias("bolinger_down"),
    )


def symbol_head(metrics: DataFrame, symbol: str, n: int = 10) -> DataFrame:
    """The first ``n`` days of one symbol's moving averages, in date order."""
    return ma_projection(metrics.filter(F.col("symbol") == symbol)).orderBy("date").limit(n)
