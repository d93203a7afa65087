"""Column layouts of the three bar layers."""

from __future__ import annotations

from pyspark.sql import types as T

# Names, order and types of a landed bar.
LANDED = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("date", T.TimestampNTZType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("volume", T.LongType()),
        T.StructField("adjClose", T.DoubleType()),
        T.StructField("adjHigh", T.DoubleType()),
        T.StructField("adjLow", T.DoubleType()),
        T.StructField("adjOpen", T.DoubleType()),
        T.StructField("adjVolume", T.LongType()),
        T.StructField("divCash", T.DoubleType()),
        T.StructField("splitFactor", T.DoubleType()),
    ]
)

# Raw bars are text throughout: a source may write any value in any way, and cleaning decides.
RAW = T.StructType([T.StructField(f.name, T.StringType()) for f in LANDED])

# Staged column -> SQL expression over a landed bar, in staged order.
# The text form serves both the DataFrame step and the persistent staging view.
STAGED_FROM_LANDED = {
    "symbol": "symbol",
    "trade_date": "CAST(date AS DATE)",
    "open": "open",
    "high": "high",
    "low": "low",
    "close": "close",
    "volume": "volume",
    "adj_open": "adjOpen",
    "adj_high": "adjHigh",
    "adj_low": "adjLow",
    "adj_close": "adjClose",
    "adj_volume": "adjVolume",
    "dividend_cash": "divCash",
    "split_factor": "splitFactor",
}

PAYLOAD = T.StructType(
    [T.StructField("symbol", T.StringType()), T.StructField("payload", T.StringType())]
)
