"""The daily metrics model and its single-indicator slices.

Staged bars must be unique on (symbol, trade_date); see ``quality.STAGED_CONSTRAINTS``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, WindowSpec, functions as F

from barline.functions.frames import Passes, run, together
from barline.operators import indicators as ind
from barline.operators.history import over_history, recent_rows, spread
from barline.operators.smoothing import exponential_averages

# Columns of the daily metrics, in order.
METRIC_COLUMNS = (
    "symbol",
    "trade_date",
    "open",
    "high",
    "low",
    "close",
    "volume",
    "adj_close",
    "daily_change",
    "daily_change_pct",
    "daily_range",
    "daily_volatility_pct",
    "daily_value_traded",
    "daily_pct_change",
    "daily_log_return",
    "ma_20",
    "ma_50",
    "ma_200",
    "bollinger_upper",
    "bollinger_lower",
    "volatility_annualized",
    "rsi_14",
    "macd_approx",
    "macd_signal_approx",
)

_KEY = ("symbol", "trade_date")
_INPUTS = (*_KEY, "open", "high", "low", "close", "volume", "adj_close")

# Earlier rows the metrics depend on: a frame of n rows reaches back n - 1, a lag one more.
LOOKBACK = max(
    max(ind.AVERAGE_PERIODS) - 1,
    ind.VOLATILITY_PERIOD,
    ind.RSI_PERIOD,
    ind.MACD_SLOW + ind.MACD_SIGNAL - 2,
)


def _indicator(
    staged: DataFrame,
    passes: Callable[[WindowSpec], Passes],
    inputs: Sequence[str],
    outputs: Sequence[str],
    lookback: int,
    rows_per_chunk: int | None,
) -> DataFrame:
    computed = over_history(
        staged.select(*_KEY, *inputs), lambda rows, spec: run(rows, passes(spec)), lookback, rows_per_chunk
    )
    return computed.select(*_KEY, *outputs)


def daily_metrics(staged: DataFrame, rows_per_chunk: int | None = None) -> DataFrame:
    """All per-day metrics: one shuffle by symbol, one sort and three window passes.

    The plain price statistics come last, so they do not travel through the shuffle.
    """

    def passes(spec: WindowSpec) -> Passes:
        return together(
            ind.volatility(spec),
            ind.moving_averages(spec),
            ind.bollinger_bands(spec),
            ind.rsi(spec),
            ind.macd(spec),
        )

    computed = over_history(
        staged.select(*_INPUTS), lambda rows, spec: run(rows, passes(spec)), LOOKBACK, rows_per_chunk
    )
    return computed.withColumns(ind.price_stats()).select(*METRIC_COLUMNS)


def daily_metrics_since(staged: DataFrame, since: date) -> DataFrame:
    """Metrics from ``since`` on, equal to the same rows of the full run.

    One scan and one shuffle: bars before the last ``LOOKBACK`` of each symbol are dropped after it,
    before anything is computed. A plain date filter would leave the frames half empty.
    """
    day = F.lit(since)
    rows = recent_rows(spread(staged.select(*_INPUTS), "symbol"), day, LOOKBACK)
    return daily_metrics(rows).filter(F.col("trade_date") >= day)


def daily_price_stats(staged: DataFrame) -> DataFrame:
    """Intraday statistics; a projection without any shuffle."""
    stats = ind.price_stats()
    return staged.select(*_KEY, *(column.alias(name) for name, column in stats.items()))


def daily_returns(staged: DataFrame, rows_per_chunk: int | None = None) -> DataFrame:
    """Simple and log return of the adjusted close."""
    outputs = ["daily_pct_change", "daily_log_return"]
    return _indicator(staged, ind.returns, ["adj_close"], outputs, 1, rows_per_chunk)


def moving_averages(
    staged: DataFrame,
    periods: Sequence[int] = ind.AVERAGE_PERIODS,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """``ma_<n>`` of the adjusted close for each period."""
    return _indicator(
        staged,
        lambda spec: ind.moving_averages(spec, periods),
        ["adj_close"],
        [f"ma_{n}" for n in periods],
        max(periods) - 1,
        rows_per_chunk,
    )


def bollinger_bands(
    staged: DataFrame,
    period: int = ind.BAND_PERIOD,
    width: float = ind.BAND_WIDTH,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Rolling deviation and bands of the adjusted close."""
    return _indicator(
        staged,
        lambda spec: ind.bollinger_bands(spec, period, width),
        ["adj_close"],
        [f"stddev_{period}", "bollinger_upper", "bollinger_lower"],
        period - 1,
        rows_per_chunk,
    )


def volatility_annualized(
    staged: DataFrame, period: int = ind.VOLATILITY_PERIOD, rows_per_chunk: int | None = None
) -> DataFrame:
    """Annualised deviation of the log returns."""
    return _indicator(
        staged,
        lambda spec: ind.volatility(spec, period),
        ["adj_close"],
        ["volatility_annualized"],
        period,
        rows_per_chunk,
    )


def gain_loss(staged: DataFrame, rows_per_chunk: int | None = None) -> DataFrame:
    """Upward and downward part of the daily change of the close."""
    return _indicator(staged, ind.gain_loss, ["close"], ["gain", "loss"], 1, rows_per_chunk)


def rsi(
    staged: DataFrame, period: int = ind.RSI_PERIOD, rows_per_chunk: int | None = None
) -> DataFrame:
    """Relative strength index of the close."""
    return _indicator(
        staged, lambda spec: ind.rsi(spec, period), ["close"], [f"rsi_{period}"], period, rows_per_chunk
    )


def macd(
    staged: DataFrame,
    fast: int = ind.MACD_FAST,
    slow: int = ind.MACD_SLOW,
    signal: int = ind.MACD_SIGNAL,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Difference of two moving averages of the close, and its signal line."""
    return _indicator(
        staged,
        lambda spec: ind.macd(spec, fast, slow, signal),
        ["close"],
        ["macd_approx", "macd_signal_approx"],
        max(fast, slow) + signal - 2,
        rows_per_chunk,
    )


def macd_ema(
    staged: DataFrame, fast: int = ind.MACD_FAST, slow: int = ind.MACD_SLOW, signal: int = ind.MACD_SIGNAL
) -> DataFrame:
    """The textbook MACD: ``ema_<fast>``, ``ema_<slow>``, their difference, its own average, and what lies between.

    Exact for histories of any length; see ``operators.smoothing`` for first rows and missing prices.
    """
    quick, calm = f"ema_{fast}", f"ema_{slow}"
    averages = exponential_averages(
        staged, {quick: fast, calm: slow}, "close", ("macd_ema_signal", quick, calm, signal)
    )
    line = F.col(quick) - F.col(calm)
    return averages.select(
        *_KEY,
        quick,
        calm,
        line.alias("macd_ema"),
        "macd_ema_signal",
        (line - F.col("macd_ema_signal")).alias("macd_ema_histogram"),
    )
