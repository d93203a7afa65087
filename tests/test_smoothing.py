"""Exponential averages against a fold over each history, and the plan of the block scan."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from conftest import BARS
from pyspark.sql import functions as F

from barline.plans.metrics import macd_ema


def folded(closes, spans=(12, 26, 9)):
    """(fast, slow, line, signal, histogram) of every row, one value after the other."""
    out, state = [], None
    a, b, c = (2 / (n + 1) for n in spans)
    for x in closes:
        if x is not None:
            if state is None:
                state = x, x, 0.0
            else:
                fast, slow = state[0] + a * (x - state[0]), state[1] + b * (x - state[1])
                state = fast, slow, state[2] + c * (fast - slow - state[2])
        out.append(state and (state[0], state[1], state[0] - state[1], state[2], state[0] - state[1] - state[2]))
    return out


def bars(spark, symbol, days, closes):
    rows = [(symbol, d, x, x, x, x, 1, x) for d, x in zip(days, closes)]
    return spark.createDataFrame(rows, BARS)


def found(df, symbol):
    rows = df.filter(F.col("symbol").eqNullSafe(F.lit(symbol))).orderBy("trade_date").drop("symbol", "trade_date").collect()
    return [tuple(r) if r[0] is not None else None for r in rows]


def same(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert (x is None) == (y is None)
        if x is not None:
            assert x == pytest.approx(y, rel=1e-12, abs=1e-10)


def test_long_histories_gaps_and_first_rows(spark):
    rng = random.Random(7)
    start = date(1950, 1, 1)
    days = [start + timedelta(days=i) for i in range(0, 18_000)]
    walk = [100 + 30 * rng.random() + i / 50 for i in range(len(days))]
    gaps = [None if i < 500 or rng.random() < 0.3 or 5000 < i < 6500 else x for i, x in enumerate(walk)]
    sparse = days[:: 400]
    table = {
        "LONG": (days, walk),
        "GAPS": (days, gaps),
        "SPARSE": (sparse, walk[: len(sparse)]),
        "ONE": (days[:1], walk[:1]),
        "NONE": (days[:400], [None] * 400),
        None: (days[:800], walk[:800]),
        "": (days[:30], walk[:30]),
    }
    frames = [bars(spark, symbol, *series) for symbol, series in table.items()]
    everything = frames[0]
    for frame in frames[1:]:
        everything = everything.unionByName(frame)
    out = macd_ema(everything.repartition(5)).cache()
    assert out.count() == sum(len(d) for d, _ in table.values())
    for symbol, (_, closes) in table.items():
        same(found(out, symbol), folded(closes))


def test_other_spans_and_rows_without_a_date(spark):
    days = [None, *(date(2020, 12, 1) + timedelta(days=i) for i in range(90))]
    closes = [float((i * 37) % 101) for i in range(len(days))]
    out = macd_ema(bars(spark, "A", days, closes), 2, 5, 3)
    assert out.columns[2:4] == ["ema_2", "ema_5"]
    same(found(out, "A"), folded(closes, (2, 5, 3)))
    with pytest.raises(ValueError):
        macd_ema(bars(spark, "A", days, closes), 1)


def test_empty(spark):
    assert macd_ema(spark.createDataFrame([], BARS)).collect() == []


def test_bars_are_shuffled_once_and_a_history_is_spread(spark, tmp_path):
    days = [date(1950, 1, 1) + timedelta(days=i) for i in range(18_000)]
    bars(spark, "HOT", days, [float(i % 97) for i in range(len(days))]).write.parquet(str(tmp_path / "bars"))
    stored = spark.read.parquet(str(tmp_path / "bars"))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        out = macd_ema(stored)
        plan = out._jdf.queryExecution().executedPlan().toString()
        # Bars move once and are read again from that shuffle; the two others move one row a block.
        assert plan.count("FileScan") == plan.count("ReusedExchange [") == 1
        assert plan.count("Exchange hashpartitioning(") == 4  # one of them in the line of the reused one
        parts = out.groupBy(F.spark_partition_id()).count().collect()
        assert len(parts) == 4 and max(r["count"] for r in parts) < 9_000
    finally:
        for name in settings:
            spark.conf.unset(name)
