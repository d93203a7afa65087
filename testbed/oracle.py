"""The registered queries as plain SQL, built from shared common table expressions."""

from __future__ import annotations

from testbed.compare import DIGITS

# Bars by supplier and by brand, in landed layout.
_LANDED = """
select symbol, cast(day as timestamp) as date, close, high, low, open, volume,
  close * f as "adjClose", high * f as "adjHigh", low * f as "adjLow", open * f as "adjOpen",
  case when f < 1 then volume * 2 else volume end as "adjVolume",
  case when extract(day from day) = 15 then 1.0::double else 0.0::double end as "divCash",
  case when day = date '1998-01-01' then 2.0::double else 1.0::double end as "splitFactor"
from (
  select symbol, day,
    arg_min(price, row(l_orderkey, l_linenumber, price)) as open,
    max(price) as high, min(price) as low,
    arg_max(price, row(l_orderkey, l_linenumber, price)) as close,
    cast(sum(l_quantity) as bigint) as volume,
    case when day < date '1998-01-01' then 0.5::double else 1.0::double end as f
  from (select {symbol} as symbol, cast(l_shipdate as date) as day,
          floor(l_extendedprice) as price, l_orderkey, l_linenumber, l_quantity
        from {source})
  group by symbol, day)
"""

LANDED = _LANDED.format(symbol="'S' || cast(l_suppkey as varchar)", source="lineitem")
LANDED_BY_BRAND = _LANDED.format(symbol="p_brand", source="lineitem join part on l_partkey = p_partkey")

# A third of the suppliers share symbols, each with days of its own.
LANDED_HOT = f"""
select * exclude (n) replace (
  case when n % 3 = 0 then 'HOT' || cast(n // 900 as varchar) else symbol end as symbol,
  case when n % 3 = 0 then cast(cast(date as date) + cast((n % 900) // 3 * 2600 as int) as timestamp) else date end as date)
from (select *, cast(substr(symbol, 2) as int) as n from ({LANDED}))
"""

STAGED = """
select symbol, cast(date as date) as trade_date, open, high, low, close, volume,
  "adjOpen" as adj_open, "adjHigh" as adj_high, "adjLow" as adj_low, "adjClose" as adj_close,
  "adjVolume" as adj_volume, "divCash" as dividend_cash, "splitFactor" as split_factor
from landed
"""

_H = "partition by symbol order by trade_date nulls first"


def _rows(n: int) -> str:
    return f"({_H} rows between {n - 1} preceding and current row)"


STEPS = f"""
select *, adj_close / nullif(lag(adj_close) over ({_H}), 0) as ratio,
  close - lag(close) over ({_H}) as step,
  avg(adj_close) over {_rows(20)} as ma_20,
  avg(adj_close) over {_rows(50)} as ma_50,
  avg(adj_close) over {_rows(200)} as ma_200,
  stddev_pop(adj_close) over {_rows(20)} as stddev_20,
  avg(close) over {_rows(12)} - avg(close) over {_rows(26)} as macd_approx
from staged
"""

DERIVED = """
select *, ratio - 1 as daily_pct_change,
  case when ratio > 0 then ln(ratio) end as daily_log_return,
  case when step is not null then greatest(step, 0) end as gain,
  case when step is not null then greatest(-step, 0) end as loss,
  ma_20 + 2 * stddev_20 as bollinger_upper, ma_20 - 2 * stddev_20 as bollinger_lower
from steps
"""

METRICS = f"""
select *, close - open as daily_change,
  (close - open) / nullif(open, 0) * 100 as daily_change_pct,
  high - low as daily_range,
  (high - low) / nullif(low, 0) * 100 as daily_volatility_pct,
  volume * close as daily_value_traded,
  stddev_pop(daily_log_return) over {_rows(252)} * sqrt(252) as volatility_annualized,
  100 - 100 / (1 + avg(gain) over {_rows(14)} / nullif(avg(loss) over {_rows(14)}, 0)) as rsi_14,
  avg(macd_approx) over {_rows(9)} as macd_signal_approx
from derived
"""


SIGNALS = """
select *,
  case when close > ma_200 then 'ABOVE_200MA' else 'BELOW_200MA' end as trend_signal,
  case when rsi_14 >= 70 then 'OVERBOUGHT' when rsi_14 <= 30 then 'OVERSOLD' else 'NEUTRAL' end as rsi_signal,
  case when macd_approx > macd_signal_approx then 'BULLISH' else 'BEARISH' end as macd_trend_signal,
  case when close > bollinger_upper then 'ABOVE_UPPER_BAND' when close < bollinger_lower then 'BELOW_LOWER_BAND'
       else 'WITHIN_BANDS' end as bollinger_signal
from metrics
"""

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

SUMMARY = f"""
select symbol, min(trade_date) as first_trading_date, max(trade_date) as last_trading_date,
  count(distinct trade_date) as trading_days, avg(close) as avg_price,
  min(close) as min_price, max(close) as max_price, avg(volume) as avg_volume,
  avg(daily_value_traded) as avg_daily_value,
  round(avg(daily_volatility_pct), {DIGITS['avg_volatility']}) as avg_volatility,
  cast(count(*) filter (where daily_change >= 0) as double) / count(*) * 100 as up_day_percentage
from metrics group by symbol
"""

# One row after the other; a missing price leaves all three averages as they are.
_NEXT = "case when o.close is null then w.{0} when w.{0} is null then o.close else w.{0} + 2.0 / {1} * (o.close - w.{0}) end"
MACD_EMA = f"""
, places as (select symbol, trade_date, close, row_number() over ({_H}) as n from staged),
walk as (
  select symbol, trade_date, n, close as fast, close as slow, case when close is not null then 0.0::double end as signal
  from places where n = 1
  union all
  select symbol, trade_date, n, fast, slow,
    case when close is null then before when before is null then 0.0 else before + 2.0 / 10 * (fast - slow - before) end
  from (
    select o.symbol, o.trade_date, o.n, o.close, {_NEXT.format('fast', 13)} as fast, {_NEXT.format('slow', 27)} as slow,
      w.signal as before
    from walk w join places o on o.symbol = w.symbol and o.n = w.n + 1)),
averages as (
  select symbol, trade_date, fast as ema_12, slow as ema_26, fast - slow as macd_ema, signal as macd_ema_signal,
    fast - slow - signal as macd_ema_histogram
  from walk)
"""

_LAYERS = {
    "landed": LANDED,
    "staged": STAGED,
    "steps": STEPS,
    "derived": DERIVED,
    "metrics": METRICS,
    "signals": SIGNALS,
}


def over(layer: str, body: str, landed: str = LANDED) -> str:
    """``body`` with the layers up to ``layer`` in scope."""
    names = list(_LAYERS)
    parts = [
        f"{name} as ({landed if name == 'landed' else _LAYERS[name]})" for name in names[: names.index(layer) + 1]
    ]
    return f"with recursive {', '.join(parts)} {body}"


def columns(*names: str) -> str:
    """A select list, rounded as ``testbed.compare.comparable`` rounds."""
    return ", ".join(f"round({c}, {DIGITS[c]}) as {c}" if c in DIGITS else c for c in names)
