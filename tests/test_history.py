"""Long histories in chunks, slices with warm-up, and the plan."""

from __future__ import annotations

import re
from datetime import date, timedelta

import pytest
from conftest import BARS, by_day
from pyspark.sql import functions as F

from barline.operators import history
from barline.plans import metrics as m


def series(symbol, days):
    return [
        (symbol, day, c, c + 1, c - 1, c, 10 + i % 5, c / 2)
        for i, day in enumerate(days)
        for c in [float(60 + (i * 37) % 101)]
    ]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    """One symbol with most rows and gaps of different length, one sparse, one short."""
    start = date(1990, 1, 1)
    daily = [start + timedelta(days=i) for i in range(1500) if i % 7 < 5 and not 300 < i < 420]
    sparse = [start + timedelta(days=40 * i) for i in range(60)]
    rows = series("HOT", daily) + series("SPARSE", sparse) + series("SHORT", daily[:30])
    return spark.createDataFrame(rows, BARS).repartition(4).cache()


@pytest.mark.parametrize("rows_per_chunk", [1, 50, 300])
def test_chunks_do_not_change_the_metrics(skewed, rows_per_chunk):
    whole = m.daily_metrics(skewed, None)
    assert by_day(m.daily_metrics(skewed, rows_per_chunk), "*") == by_day(whole, "*")


def test_chunks_are_small_and_cover_every_row_once(skewed):
    tagged = history.assign_chunks(skewed, history.plan_chunks(skewed, m.LOOKBACK, 100))
    own = tagged.filter(~F.col(history.WARM_UP))
    assert own.count() == skewed.count()
    per_chunk = own.groupBy("symbol", history.CHUNK).count()
    largest = {r.symbol: r.rows for r in per_chunk.groupBy("symbol").agg(F.max("count").alias("rows")).collect()}
    # A chunk ends with the month in which it reaches its size.
    assert largest["HOT"] < 100 + 31
    assert largest["SPARSE"] == 60
    most = tagged.groupBy("symbol", history.CHUNK).count().agg(F.max("count")).first()[0]
    assert most < 100 + m.LOOKBACK + 3 * 31


@pytest.mark.parametrize("rows_per_chunk", [None, 100])
def test_partitions_follow_the_size_on_every_path(spark, skewed, monkeypatch, tmp_path, rows_per_chunk):
    skewed.write.parquet(str(tmp_path / "bars"))
    bars = spark.read.parquet(str(tmp_path / "bars"))
    monkeypatch.setattr(history, "BYTES_PER_PARTITION", 2_000)
    keys = "symbol" if rows_per_chunk is None else f"symbol.*{history.CHUNK}"
    out = m.daily_metrics(bars, rows_per_chunk)
    exchanges = [int(n) for n in re.findall(rf"Exchange hashpartitioning\({keys}#\d+, (\d+)\)", plan_of(out))]
    assert exchanges and max(exchanges) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert out.count() == bars.count()
    monkeypatch.setattr(history, "BYTES_PER_PARTITION", 1)
    assert history.partitions_for(bars) > 1000


def test_rows_without_symbol_or_date_survive_chunking(spark, skewed):
    odd = spark.createDataFrame(
        [(None, date(1990, 1, 1 + i), 1.0, 1.0, 1.0, 1.0, 1, 1.0) for i in range(5)]
        + [("HOT", None, 1.0, 1.0, 1.0, 1.0, 1, 1.0)],
        BARS,
    )
    bars = skewed.unionByName(odd)
    assert by_day(m.daily_metrics(bars, 4), "*") == by_day(m.daily_metrics(bars, None), "*")


def test_slice_equals_full_run(skewed):
    since = date(1993, 1, 1)
    full = m.daily_metrics(skewed).filter(F.col("trade_date") >= F.lit(since))
    assert by_day(m.daily_metrics_since(skewed, since), "*") == by_day(full, "*")


def test_slice_with_rows_without_a_date(spark, skewed):
    bars = skewed.unionByName(spark.createDataFrame([("HOT", None, *[1.0] * 4, 1, 1.0)], BARS))
    since = date(1993, 1, 1)
    full = m.daily_metrics(bars).filter(F.col("trade_date") >= F.lit(since))
    assert by_day(m.daily_metrics_since(bars, since), "*") == by_day(full, "*")


def test_slice_is_one_scan_one_shuffle_and_one_sort(spark, skewed, tmp_path):
    path = str(tmp_path / "bars")
    skewed.write.parquet(path)
    plan = plan_of(m.daily_metrics_since(spark.read.parquet(path), date(1993, 1, 1)))
    assert plan.count("FileScan") == plan.count("Exchange") == plan.count("Sort [") == 1


def test_one_shuffle_and_three_window_passes(spark, skewed, tmp_path):
    path = str(tmp_path / "bars")
    skewed.write.parquet(path)
    plan = plan_of(m.daily_metrics(spark.read.parquet(path), None))
    assert plan.count("Exchange") == 1
    assert plan.count("Exchange hashpartitioning(symbol") == 1
    assert plan.count("Sort [") == 1
    assert plan.count("Window [") == 3


def test_single_indicator_reads_only_its_columns(spark, skewed, tmp_path):
    path = str(tmp_path / "bars")
    skewed.write.parquet(path)
    plan = plan_of(m.rsi(spark.read.parquet(path), rows_per_chunk=None))
    assert "ReadSchema: struct<symbol:string,trade_date:date,close:double>" in plan


def test_symbol_filter_reaches_the_scan_and_date_filter_does_not(spark, skewed, tmp_path):
    path = str(tmp_path / "bars")
    skewed.write.parquet(path)
    metrics = m.daily_metrics(spark.read.parquet(path), None)
    plan = plan_of(metrics.filter("symbol = 'HOT' AND trade_date >= DATE'1993-01-01'"))
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "EqualTo(symbol,HOT)" in scan
    assert "1993-01-01" not in scan


def test_only_long_histories_are_cut_and_rows_move_once(spark, skewed, tmp_path):
    plan = history.plan_chunks(skewed, m.LOOKBACK, 100)
    assert {r.symbol for r in plan.select("symbol").distinct().collect()} == {"HOT"}
    skewed.write.parquet(str(tmp_path / "bars"))
    out = m.daily_metrics(spark.read.parquet(str(tmp_path / "bars")), 100)
    text = plan_of(out)
    assert text.count("Exchange hashpartitioning(") == 1 and "BroadcastHashJoin" in text
    # The longest history is spread over tasks.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = out.filter("symbol = 'HOT'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    total = sum(r["count"] for r in parts)
    assert len(parts) == 4 and max(r["count"] for r in parts) < total / 2


def test_the_plan_of_a_very_long_history_stays_small(spark):
    """Thousands of months: each row of the plan holds the chunks of its own month only."""
    days = [date(1000, 1, 1) + timedelta(days=15 * i) for i in range(48_000)]
    bars = spark.createDataFrame(series("LONG", days), BARS)
    plan = history.plan_chunks(bars, m.LOOKBACK, 2_000)
    sizes = plan.agg(F.count("*").alias("rows"), F.max(F.size("chunks")).alias("most")).first()
    assert sizes.rows > 20_000 and sizes.most <= 3
    out = m.daily_metrics(bars, 2_000)
    assert out.count() == len(days)


def test_frames_are_put_together_from_blocks_and_compiled(spark, skewed, tmp_path):
    """No frame of more than the signal line's 9 rows is read row by row, and no generated method is too long for Java to compile."""
    path = str(tmp_path / "bars")
    skewed.write.parquet(path)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        executed = m.daily_metrics(spark.read.parquet(path), None)._jdf.queryExecution().executedPlan()
        code = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(executed)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sliding = re.findall(r"RowFrame, -(\d+), currentrow\$", executed.toString())
    assert sliding and set(sliding) == {"8"}
    assert max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)) < 8000
