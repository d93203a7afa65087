"""Per-symbol indicators, each as the passes that compute it over a window of one history.

Returns, moving averages, bands and volatility use the adjusted close; gain, loss, RSI and
MACD use the raw close, as does everything daily. Averages are simple, also in RSI and MACD.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, WindowSpec, functions as F

from barline.functions.frames import (
    Pass,
    Passes,
    earlier,
    lagged,
    rolling,
    rolling_means,
    rows_of_first_block,
    then,
    together,
)
from barline.functions.scalars import positive_part, safe_divide, safe_ln

# Periods and the band width of the indicators.
AVERAGE_PERIODS = (20, 50, 200)
BAND_PERIOD = 20
BAND_WIDTH = 2.0
VOLATILITY_PERIOD = 252
RSI_PERIOD = 14
MACD_FAST, MACD_SLOW, MACD_SIGNAL = 12, 26, 9


def price_stats() -> dict[str, Column]:
    """Intraday change, range and traded value; plain columns, no window involved."""
    change, spread = F.col("close") - F.col("open"), F.col("high") - F.col("low")
    return {
        "daily_change": change,
        "daily_change_pct": safe_divide(change, F.col("open")) * 100,
        "daily_range": spread,
        "daily_volatility_pct": safe_divide(spread, F.col("low")) * 100,
        "daily_value_traded": F.col("volume") * F.col("close"),
    }


def _returns(spec: WindowSpec, price: str, rows: int) -> Pass:
    """Simple and log return of this row, and the log returns of the ``rows - 1`` rows before."""
    at = [F.col(earlier(price, k)) for k in range(rows + 1)]
    ratio = [earlier("__ratio", k) for k in range(rows)]
    return Pass(
        lagged(spec, price, rows),
        (
            {name: safe_divide(at[k], at[k + 1]) for k, name in enumerate(ratio)},
            {
                "daily_pct_change": F.col(ratio[0]) - 1,
                **{earlier("daily_log_return", k): safe_ln(F.col(name)) for k, name in enumerate(ratio)},
            },
        ),
    )


def returns(spec: WindowSpec, price: str = "adj_close") -> Passes:
    """Simple and log return against the previous trading row."""
    return [_returns(spec, price, 1)]


def moving_averages(
    spec: WindowSpec, periods: Sequence[int] = AVERAGE_PERIODS, price: str = "adj_close"
) -> Passes:
    """``ma_<n>`` for each period."""
    return rolling(spec, price, {f"ma_{n}": n for n in periods})


def bollinger_bands(
    spec: WindowSpec, period: int = BAND_PERIOD, width: float = BAND_WIDTH, price: str = "adj_close"
) -> Passes:
    """Moving average plus and minus ``width`` population deviations."""
    middle, deviation = f"ma_{period}", f"stddev_{period}"
    reach = F.col(deviation) * width
    bands = {"bollinger_upper": F.col(middle) + reach, "bollinger_lower": F.col(middle) - reach}
    return then(rolling(spec, price, {middle: period}, {deviation: period}), bands)


def volatility(spec: WindowSpec, period: int = VOLATILITY_PERIOD, price: str = "adj_close") -> Passes:
    """Annualised deviation of the log returns."""
    made = _returns(spec, price, rows_of_first_block(period))
    annual = {"volatility_annualized": F.col("__deviation") * math.sqrt(period)}
    return then(rolling(spec, "daily_log_return", {}, {"__deviation": period}, made), annual)


def _gain_loss(spec: WindowSpec, price: str, rows: int) -> Pass:
    """Gain and loss of this row and of the ``rows - 1`` rows before."""
    at = [F.col(earlier(price, k)) for k in range(rows + 1)]
    step = [earlier("__step", k) for k in range(rows)]
    return Pass(
        lagged(spec, price, rows),
        (
            {name: at[k] - at[k + 1] for k, name in enumerate(step)},
            {
                **{earlier("gain", k): positive_part(F.col(name)) for k, name in enumerate(step)},
                **{earlier("loss", k): positive_part(-F.col(name)) for k, name in enumerate(step)},
            },
        ),
    )


def gain_loss(spec: WindowSpec, price: str = "close") -> Passes:
    """Upward and downward part of the change since the previous row; NULL if either price is."""
    return [_gain_loss(spec, price, 1)]


def rsi(spec: WindowSpec, period: int = RSI_PERIOD, price: str = "close") -> Passes:
    """Relative strength index; NULL, not 100, when there was no loss."""
    made = _gain_loss(spec, price, rows_of_first_block(period))
    strength = safe_divide(F.col("__gain"), F.col("__loss"))
    averages = together(
        rolling(spec, "gain", {"__gain": period}, made=made),
        rolling(spec, "loss", {"__loss": period}, made=made, counts="gain"),
    )
    return then(averages, {f"rsi_{period}": 100 - 100 / (1 + strength)})


def macd(
    spec: WindowSpec,
    fast: int = MACD_FAST,
    slow: int = MACD_SLOW,
    signal: int = MACD_SIGNAL,
    price: str = "close",
) -> Passes:
    """Fast minus slow moving average, and the moving average of that line."""
    line = {"macd_approx": F.col("__fast") - F.col("__slow")}
    averages = then(rolling(spec, price, {"__fast": fast, "__slow": slow}), line)
    return [*averages, *rolling_means(spec, "macd_approx", {"macd_signal_approx": signal})]
