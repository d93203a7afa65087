"""Hand-checked series."""

from __future__ import annotations

import math
import statistics
from datetime import date
from random import Random

import pytest
from conftest import BARS, by_day
from pyspark.sql import functions as F

from barline.functions.frames import block_width
from barline.operators.signals import trade_signals
from barline.operators.summary import symbol_summary
from barline.plans import metrics as m


def signals(bars):
    return trade_signals(m.daily_metrics(bars))


def test_mini_series(make_bars):
    bars = make_bars([100.0, 110.0, 99.0, 99.0])
    out = m.daily_metrics(bars)
    assert by_day(out, "daily_pct_change") == [None, 0.1, -0.1, 0.0]
    assert by_day(out, "ma_20") == by_day(out, "ma_50") == by_day(out, "ma_200") == [100.0, 105.0, 103.0, 102.0]
    assert by_day(out, "volatility_annualized") == [None, 0.0, 1.592774, 1.301038]
    assert by_day(out, "rsi_14") == [None, None, 47.619048, 47.619048]
    assert by_day(out, "macd_approx", "macd_signal_approx") == [(0.0, 0.0)] * 4
    assert by_day(m.bollinger_bands(bars), "stddev_20") == [0.0, 5.0, 4.966555, 4.636809]
    assert by_day(m.gain_loss(bars), "gain", "loss") == [(None, None), (10.0, 0.0), (0.0, 11.0), (0.0, 0.0)]


def test_only_rising_price_has_no_strength(make_bars):
    out = signals(make_bars([float(i) for i in range(1, 61)]))
    assert by_day(out, "rsi_14") == [None] * 60
    assert set(by_day(out, "rsi_signal")) == {"NEUTRAL"}


def test_only_falling_price_is_oversold(make_bars):
    out = signals(make_bars([100.0 - i for i in range(60)]))
    assert by_day(out, "rsi_14") == [None] + [0.0] * 59
    assert by_day(out, "rsi_signal") == ["NEUTRAL"] + ["OVERSOLD"] * 59


def test_flat_price(make_bars):
    out = signals(make_bars([64.0] * 300))
    assert set(by_day(out, "bollinger_upper", "bollinger_lower")) == {(64.0, 64.0)}
    assert by_day(out, "volatility_annualized") == [None] + [0.0] * 299
    labels = by_day(out, "trend_signal", "rsi_signal", "macd_trend_signal", "bollinger_signal")
    assert set(labels) == {("BELOW_200MA", "NEUTRAL", "BEARISH", "WITHIN_BANDS")}


def test_steady_growth_has_no_volatility(make_bars):
    out = m.volatility_annualized(make_bars([100.0 * 1.01**i for i in range(600)]))
    assert max(by_day(out.filter("volatility_annualized IS NOT NULL"), "volatility_annualized")) == 0.0


def test_ramp(make_bars):
    out = signals(make_bars([float(i) for i in range(1, 31)]))
    rows = by_day(out, "macd_approx", "macd_signal_approx", "macd_trend_signal")
    assert rows[11] == (0.0, 0.0, "BEARISH")
    assert rows[12] == (0.5, 0.055556, "BULLISH")
    assert rows[19] == (4.0, 2.0, "BULLISH")
    assert rows[25] == (7.0, 5.0, "BULLISH")
    assert rows[29] == (7.0, 6.444444, "BULLISH")


def test_zero_prices_give_null_not_errors(make_bars):
    out = m.daily_metrics(make_bars([10.0, 0.0, 20.0, 5.0]))
    assert by_day(out, "daily_change_pct") == [0.0, None, 0.0, 0.0]
    assert by_day(out, "daily_volatility_pct") == [0.0, None, 0.0, 0.0]
    assert by_day(out, "daily_pct_change") == [None, -1.0, None, -0.75]
    assert by_day(out, "daily_log_return") == [None, None, None, -1.386294]


def test_negative_price_has_no_log_return(make_bars):
    assert by_day(m.daily_returns(make_bars([10.0, -5.0])), "daily_log_return") == [None, None]


def test_null_close_blanks_two_steps(make_bars):
    bars = make_bars([10.0, 12.0, None, 15.0, 14.0])
    assert by_day(m.gain_loss(bars), "gain", "loss") == [
        (None, None),
        (2.0, 0.0),
        (None, None),
        (None, None),
        (0.0, 1.0),
    ]
    out = signals(bars)
    assert by_day(out, "ma_20") == [10.0, 11.0, 11.0, 12.333333, 12.75]
    assert by_day(out, "ma_200") == by_day(out, "ma_20")
    labels = by_day(out, "trend_signal", "bollinger_signal")
    assert labels[2] == ("BELOW_200MA", "WITHIN_BANDS")


def test_long_frames_skip_nulls_and_leave_all_null_frames_null(make_bars):
    closes = [None if i < 60 or i % 7 == 0 else float(i) for i in range(400)]
    out = by_day(m.moving_averages(make_bars(closes)), "ma_50", "ma_200")
    for i in (0, 59, 61, 130, 399):
        for value, width in zip(out[i], (50, 200)):
            known = [c for c in closes[max(0, i - width + 1) : i + 1] if c is not None]
            assert value == (round(sum(known) / len(known), 6) if known else None)


def test_split_shows_only_in_raw_price_indicators(make_bars):
    bars = make_bars([100.0, 102.0, 51.0, 52.0], adj=[50.0, 51.0, 51.0, 52.0])
    out = m.daily_metrics(bars)
    assert by_day(out, "daily_pct_change") == [None, 0.02, 0.0, 0.019608]
    assert by_day(m.gain_loss(bars), "loss")[2] == 51.0


def test_order_of_input_and_other_symbols_do_not_matter(make_bars):
    a, b = make_bars([100.0, 110.0, 99.0, 99.0]), make_bars([5.0, 4.0, 6.0], symbol="B")
    mixed = m.daily_metrics(a.unionByName(b).orderBy(F.rand(1)))
    for symbol, alone in (("A", a), ("B", b)):
        expected = m.daily_metrics(alone)
        assert by_day(mixed.filter(F.col("symbol") == symbol), "*") == by_day(expected, "*")


def test_empty_input_gives_empty_output(spark):
    empty = spark.createDataFrame([], BARS)
    assert signals(empty).isEmpty()
    assert symbol_summary(m.daily_metrics(empty)).isEmpty()


def test_bounds(make_bars):
    closes = [float(50 + (i * 37) % 101) for i in range(400)]
    out = m.daily_metrics(make_bars(closes))
    assert out.filter("NOT (bollinger_upper >= ma_20 AND ma_20 >= bollinger_lower)").isEmpty()
    assert out.filter("rsi_14 < 0 OR rsi_14 > 100").isEmpty()


def test_other_periods(make_bars):
    closes = [float(50 + (i * 37) % 101) for i in range(300)]
    bars = make_bars(closes)
    periods = [3, 37, 60, 90]
    out = by_day(m.moving_averages(bars, periods), *(f"ma_{n}" for n in periods))
    for i in (0, 36, 37, 299):
        for value, n in zip(out[i], periods):
            part = closes[max(0, i - n + 1) : i + 1]
            assert value == pytest.approx(sum(part) / len(part), abs=1e-6)
    long = by_day(m.macd(bars, fast=40, slow=80, signal=36), "macd_approx")
    assert long[-1] == pytest.approx(sum(closes[-40:]) / 40 - sum(closes[-80:]) / 80, abs=1e-6)


def test_summary(make_bars):
    bars = make_bars([10.0, 20.0, 30.0, 40.0], open=[10.0, 25.0, 25.0, None])
    row = symbol_summary(m.daily_metrics(bars)).first()
    assert (row.first_trading_date, row.last_trading_date) == (date(2024, 1, 1), date(2024, 1, 4))
    assert row.trading_days == 4
    assert (row.avg_price, row.min_price, row.max_price, row.avg_volume) == (25.0, 10.0, 40.0, 10.0)
    # Flat counts as up, falling and unknown do not.
    assert row.up_day_percentage == 50.0


def test_block_width():
    assert block_width([50, 200]) == 25
    assert block_width([37]) in (1, 37)
    assert 252 % block_width([252]) == 0


def test_random_series_match_brute_force(make_bars):
    """Every metric against its definition, row by row, with gaps and repeated prices."""
    random = Random(7)
    closes = [None if random.random() < 0.04 else round(random.uniform(20, 25), 1) for _ in range(420)]
    adj = [None if c is None or random.random() < 0.02 else c / 2 for c in closes]
    rows = m.daily_metrics(make_bars(closes, adj=adj)).orderBy("trade_date").collect()

    def last(values, i, n):
        return [v for v in values[max(0, i - n + 1) : i + 1] if v is not None]

    def mean(values):
        return statistics.fmean(values) if values else None

    def both(a, b, f):
        return None if a is None or b is None else f(a, b)

    previous = [None, *closes[:-1]]
    ratios = [both(a, b, lambda x, y: x / y) for a, b in zip(adj, [None, *adj[:-1]])]
    logs = [None if r is None else math.log(r) for r in ratios]
    gains = [both(a, b, lambda x, y: max(x - y, 0.0)) for a, b in zip(closes, previous)]
    losses = [both(a, b, lambda x, y: max(y - x, 0.0)) for a, b in zip(closes, previous)]
    macds = [both(mean(last(closes, i, 12)), mean(last(closes, i, 26)), lambda x, y: x - y) for i in range(len(closes))]
    for i, row in enumerate(rows):
        twenty = last(adj, i, 20)
        band = 2 * statistics.pstdev(twenty) if twenty else None
        gain, loss = mean(last(gains, i, 14)), mean(last(losses, i, 14))
        returns = last(logs, i, 252)
        expected = {
            "daily_pct_change": None if ratios[i] is None else ratios[i] - 1,
            "daily_log_return": logs[i],
            "ma_20": mean(twenty),
            "ma_50": mean(last(adj, i, 50)),
            "ma_200": mean(last(adj, i, 200)),
            "bollinger_upper": both(mean(twenty), band, lambda x, y: x + y),
            "bollinger_lower": both(mean(twenty), band, lambda x, y: x - y),
            "volatility_annualized": statistics.pstdev(returns) * math.sqrt(252) if returns else None,
            "rsi_14": None if not loss else 100 - 100 / (1 + gain / loss),
            "macd_approx": macds[i],
            "macd_signal_approx": mean(last(macds, i, 9)),
        }
        for name, value in expected.items():
            assert row[name] == (None if value is None else pytest.approx(value, abs=1e-9)), (i, name)
