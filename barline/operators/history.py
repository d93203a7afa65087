"""Run window operators over histories of any length.

A window is computed by one task per partition key. Bars that are unique on (symbol, trade_date) bound
a symbol's history by the calendar, and are computed whole. For sources without that bound, ``rows_per_chunk``
cuts longer histories at month starts into chunks, each preceded by enough earlier
rows to fill every frame (the warm-up), which are dropped after the computation. The result is
the same rows either way.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from barline.functions.frames import history
from barline.session import scratch_path

# Bytes, as the plan estimates them, that one task should get. Those of compressed files, which rows in a sort take ten times of and more.
BYTES_PER_PARTITION = 8 << 20

# What plans say of sources without a size, unless configured otherwise.
_UNKNOWN = 2**63 - 1

CHUNK, WARM_UP = "__chunk", "__warm_up"

Compute = Callable[[DataFrame, WindowSpec], DataFrame]


def _day() -> Column:
    """The date used to place a row; NULL dates sort first, so they join the first chunk."""
    return F.coalesce(F.col("trade_date"), F.lit("0001-01-01").cast("date"))


def partitions_for(df: DataFrame) -> int:
    """Partitions that the size of what ``df`` reads asks for, as its plan knows it without running anything.

    Sources of unknown size, such as rows of the driver, ask for none beyond the first.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return max(1, math.ceil(sum(size for size in sizes if size < _UNKNOWN) / BYTES_PER_PARTITION))


def plan_chunks(bars: DataFrame, lookback: int, rows_per_chunk: int) -> DataFrame:
    """(symbol, month, chunks): the chunks that rows of a month go to, the later ones as warm-up, from one count by month.

    Only histories longer than ``rows_per_chunk`` are listed. Chunks begin with a month, so a month's rows stay together, and one
    row of the plan serves all of them.
    """
    months = bars.groupBy("symbol", F.trunc(_day(), "month").alias("month")).agg(F.count("*").alias("rows"))
    # A symbol has at most 12 months for each year of the calendar, so these windows stay small.
    whole = Window.partitionBy("symbol")
    by_month = whole.orderBy("month")
    before = F.coalesce(F.sum("rows").over(by_month.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # The latest month that has at least ``lookback`` rows between its start and this month.
    reach = F.max("month").over(whole.orderBy("before").rangeBetween(Window.unboundedPreceding, -lookback))
    placed = (
        months.withColumn("total", F.sum("rows").over(whole))
        .filter(F.col("total") > rows_per_chunk)
        .withColumn("before", before)
        .withColumns({"chunk": F.floor(F.col("before") / rows_per_chunk).cast("int"), "reach": reach})
        .withColumn("warm_from", F.coalesce("reach", F.min("month").over(whole)))
    )
    entry = F.struct(F.col("chunk").alias(CHUNK), F.col("warm_up").alias(WARM_UP))
    own = placed.select("symbol", "month", "chunk", F.lit(False).alias("warm_up"))
    # The months before each chunk, back to where its warm-up begins; those without rows meet nothing.
    chunks = placed.groupBy("symbol", "chunk").agg(F.min("month").alias("start"), F.min("warm_from").alias("warm_from"))
    before = F.sequence("warm_from", F.add_months("start", -1), F.expr("interval 1 month"))
    warmed = chunks.filter("warm_from < start").select(
        "symbol", F.explode(before).alias("month"), "chunk", F.lit(True).alias("warm_up")
    )
    return own.unionByName(warmed).groupBy("symbol", "month").agg(F.collect_list(entry).alias("chunks"))


def assign_chunks(bars: DataFrame, plan: DataFrame) -> DataFrame:
    """Tag each row with its chunk, and repeat rows that warm up a later chunk; histories not in the plan are one chunk.

    The plan is broadcast if it is stored and small; otherwise adaptive execution splits the rows of a hot symbol in this join.
    """
    months = plan.select(F.col("symbol").alias("__symbol"), F.col("month").alias("__month"), "chunks")
    on = F.col("symbol").eqNullSafe(F.col("__symbol")) & (F.trunc(_day(), "month") == F.col("__month"))
    only = F.array(F.struct(F.lit(0).alias(CHUNK), F.lit(False).alias(WARM_UP)))
    joined = bars.join(months, on, "left")
    return joined.select(*bars.columns, F.inline(F.coalesce("chunks", only)))


def over_history(bars: DataFrame, compute: Compute, lookback: int, rows_per_chunk: int | None = None) -> DataFrame:
    """Apply ``compute(rows, window)`` to each symbol's history.

    ``compute`` may add columns but must keep the rows; ``lookback`` is the number of earlier rows its result can
    depend on. Cutting first counts the rows of ``bars`` by month, from two of their columns, and stores the plan; rows then move once.
    """
    if rows_per_chunk is None:
        return compute(spread(bars, "symbol"), history("symbol"))
    spark, path = bars.sparkSession, scratch_path(bars.sparkSession, "chunks")
    plan_chunks(bars, lookback, rows_per_chunk).write.parquet(path)
    cut = assign_chunks(bars, spark.read.parquet(path))
    computed = compute(spread(cut, "symbol", CHUNK), history("symbol", CHUNK))
    return computed.filter(~F.col(WARM_UP)).drop(CHUNK, WARM_UP)


def spread(bars: DataFrame, *keys: str) -> DataFrame:
    """Use more shuffle partitions than configured where the size asks for them.

    Adaptive execution merges small partitions but cannot split one that feeds a window.
    """
    partitions = partitions_for(bars)
    configured = int(bars.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return bars.repartition(partitions, *keys) if partitions > configured else bars


def recent_rows(bars: DataFrame, since: Column, lookback: int) -> DataFrame:
    """Rows from ``since`` on and the last ``lookback`` rows of each symbol before.

    Ranks and counts use the partitioning and order of the indicators, so what follows needs no other shuffle or sort.
    """
    in_order = history("symbol")
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = F.count_if(F.col("trade_date") < since).over(whole)
    # Rows without a date come first in the order and belong to no day.
    undated = F.count_if(F.col("trade_date").isNull()).over(whole)
    placed = bars.withColumns({"__place": F.row_number().over(in_order), "__earlier": earlier + undated})
    return placed.filter(F.col("__place") > F.col("__earlier") - lookback).drop("__place", "__earlier")
