"""Per-symbol summary of the whole history."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from barline.functions.scalars import safe_divide


def symbol_summary(metrics: DataFrame) -> DataFrame:
    """One row per symbol. A flat day counts as up; a NULL change counts as a day, not as up."""
    up_days = F.count_if(F.col("daily_change") >= 0)
    return metrics.groupBy("symbol").agg(
        F.min("trade_date").alias("first_trading_date"),
        F.max("trade_date").alias("last_trading_date"),
        F.count_distinct("trade_date").alias("trading_days"),
        F.avg("close").alias("avg_price"),
        F.min("close").alias("min_price"),
        F.max("close").alias("max_price"),
        F.avg("volume").alias("avg_volume"),
        F.avg("daily_value_traded").alias("avg_daily_value"),
        F.avg("daily_volatility_pct").alias("avg_volatility"),
        (safe_divide(up_days, F.count("*")) * 100).alias("up_day_percentage"),
    )


# Column of the summary -> column of the metrics it averages.
_AVERAGES = {
    "avg_price": "close",
    "avg_volume": "volume",
    "avg_daily_value": "daily_value_traded",
    "avg_volatility": "daily_volatility_pct",
}


def summary_parts(metrics: DataFrame, unique: bool = False) -> DataFrame:
    """One row per symbol and month, from which ``merged_summary`` makes the summary of any set of months.

    Days are counted exactly by month, and months share no day, so their sum is exact. Where (symbol, trade_date) is known to be
    ``unique`` every row with a day is a day of its own, and rows are combined before they move.
    """
    days = F.count("trade_date") if unique else F.count_distinct("trade_date")
    sums = [
        column
        for source in _AVERAGES.values()
        for column in (F.sum(source).alias(f"{source}_sum"), F.count(source).alias(f"{source}_count"))
    ]
    return metrics.groupBy("symbol", F.trunc("trade_date", "month").alias("month")).agg(
        F.min("trade_date").alias("first_trading_date"),
        F.max("trade_date").alias("last_trading_date"),
        days.alias("trading_days"),
        F.min("close").alias("min_price"),
        F.max("close").alias("max_price"),
        F.count_if(F.col("daily_change") >= 0).alias("up_rows"),
        F.count("*").alias("rows"),
        *sums,
    )


def merged_summary(parts: DataFrame) -> DataFrame:
    """The summary of the rows behind the parts, equal to ``symbol_summary`` but for the order in which sums are added."""
    averages = {
        name: safe_divide(F.sum(f"{source}_sum"), F.sum(f"{source}_count")).alias(name) for name, source in _AVERAGES.items()
    }
    return parts.groupBy("symbol").agg(
        F.min("first_trading_date").alias("first_trading_date"),
        F.max("last_trading_date").alias("last_trading_date"),
        F.sum("trading_days").alias("trading_days"),
        averages["avg_price"],
        F.min("min_price").alias("min_price"),
        F.max("max_price").alias("max_price"),
        averages["avg_volume"],
        averages["avg_daily_value"],
        averages["avg_volatility"],
        (safe_divide(F.sum("up_rows"), F.sum("rows")) * 100).alias("up_day_percentage"),
    )
