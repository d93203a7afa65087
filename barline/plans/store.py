"""Bars and metrics stored by year, so that recent days are refreshed without touching the years before.

A store is a folder with four parts: ``bars`` (staged bars), ``metrics``, ``counts`` (rows by symbol and year) and ``parts``
(the states the summary is merged from, by symbol and month). Each has one folder a year and run; a commit lists the folders that are
current (see ``sources.versions``). A refresh writes the years it changes and commits them beside the others' old folders, so
readers see all of a refresh or none of it, and files of other years stay as they are.

The counts say which years hold the rows before a day that its metrics depend on, so only those are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from barline.operators import quality
from barline.operators.history import partitions_for
from barline.operators.summary import merged_summary, summary_parts
from barline.plans.metrics import LOOKBACK, daily_metrics
from barline.sources import versions

BARS, METRICS, COUNTS, PARTS = "bars", "metrics", "counts", "parts"
_YEAR = "year"
# Fixed value: bars or metrics behind a row of the counts and parts, at least about.
_ROWS_A_PART = 8


def _year() -> Column:
    return F.year("trade_date").alias(_YEAR)


def _key(part: str, year: int) -> str:
    return f"{part}/{year}"


def _write(df: DataFrame, root: str, part: str, run: str) -> DataFrame:
    """Write a part's years, and read them."""
    path = f"{root}/{part}/version={run}"
    df.write.partitionBy(_YEAR).parquet(path)
    return df.sparkSession.read.option("basePath", f"{root}/{part}").parquet(path).drop("version")


def _written(spark: SparkSession, root: str, part: str, run: str) -> dict[str, str]:
    """The folders of a written part's years by key."""
    base = f"{part}/version={run}"
    files, folder = versions.file_system(spark, f"{root}/{base}")
    found = (status.getPath().getName() for status in files.listStatus(folder) if status.isDirectory())
    years = sorted(int(name.removeprefix(f"{_YEAR}=")) for name in found if name.startswith(f"{_YEAR}="))
    return {_key(part, year): f"{base}/{_YEAR}={year}" for year in years}


def _by_year(df: DataFrame, order: str = "trade_date", rows_behind: int = 1) -> DataFrame:
    """Rows of a year lie together, in as many files as the size of all asks for, symbols in order.

    ``rows_behind`` says how many of the rows that are read became one.
    """
    share = F.pmod(F.hash("symbol"), F.lit(math.ceil(partitions_for(df) / rows_behind)))
    return df.repartition(_YEAR, share).sortWithinPartitions(_YEAR, "symbol", order)


def _last(spark: SparkSession, root: str) -> versions.Commit:
    last = versions.current(spark, root)
    if last is None:
        raise FileNotFoundError(f"nothing is stored in {root}")
    return last


def _years(last: versions.Commit, part: str) -> dict[int, str]:
    return {int(key.split("/")[1]): folder for key, folder in last.folders.items() if key.split("/")[0] == part}


def read(spark: SparkSession, root: str, part: str = METRICS, years: Iterable[int] | None = None) -> DataFrame:
    """The current rows of a part, of all years or of some; ``year`` is a column."""
    folders = _years(_last(spark, root), part)
    wanted = sorted(folders if years is None else set(folders).intersection(years))
    # Without a wanted year any other tells the columns.
    listed = [f"{root}/{folders[y]}" for y in wanted or sorted(folders)[:1]]
    rows = spark.read.option("basePath", f"{root}/{part}").parquet(*listed).drop("version")
    return rows if wanted else rows.limit(0)


def _store(spark: SparkSession, root: str, bars: DataFrame, since: int | None, last: versions.Commit | None) -> versions.Commit:
    """Write bars of whole years and all that follows from them, from ``since`` on, and commit."""
    run = versions.new_version()
    folders: dict[str, str] = {}
    try:
        # Checked as stored: that reads two columns, and whatever makes the bars runs once.
        new = _write(_by_year(bars.withColumn(_YEAR, _year())), root, BARS, run)
        quality.require(new, quality.STAGED_CONSTRAINTS, "bars")
        counted = new.groupBy(_YEAR, "symbol").agg(F.count("*").alias("rows"))
        _write(_by_year(counted, "rows", _ROWS_A_PART), root, COUNTS, run)
        rows = new.drop(_YEAR)
        if since is not None and last is not None:
            rows = warm_up(spark, root, new, since, last).drop(_YEAR).unionByName(rows)
        metrics = daily_metrics(rows).withColumn(_YEAR, _year())
        if since is not None:
            metrics = metrics.filter(F.col("trade_date") >= F.lit(date(since, 1, 1)))
        fresh = _write(_by_year(metrics), root, METRICS, run)
        parts = summary_parts(fresh, unique=True).withColumn(_YEAR, F.year("month"))
        _write(_by_year(parts, "month", _ROWS_A_PART), root, PARTS, run)
        for part in (BARS, COUNTS, METRICS, PARTS):
            folders |= _written(spark, root, part, run)
        kept = {}
        if since is not None and last is not None:
            kept = {key: folder for key, folder in last.folders.items() if int(key.split("/")[1]) < since}
        made = versions.commit(spark, root, kept | folders, {}, last)
    except Exception:
        for part in (BARS, METRICS, COUNTS, PARTS):
            versions.remove(spark, f"{root}/{part}/version={run}")
        raise
    versions.prune(spark, root)
    return made


def store_bars(bars: DataFrame, root: str) -> versions.Commit:
    """Store staged bars and their metrics, in place of what was stored. Every bar needs a symbol and a day of its own."""
    return _store(bars.sparkSession, root, bars, None, versions.current(bars.sparkSession, root))


def warm_years(counts: DataFrame, symbols: DataFrame, year: int, lookback: int = LOOKBACK) -> DataFrame:
    """(symbol, year): years before ``year`` that hold the last ``lookback`` rows before it, for the symbols given.

    ``counts`` has the rows of each symbol and year. A symbol's years are few, so the window over them stays small.
    """
    later = Window.partitionBy("symbol").orderBy(F.col(_YEAR).desc()).rowsBetween(Window.unboundedPreceding, -1)
    earlier = counts.filter(F.col(_YEAR) < year).join(symbols.select("symbol").distinct(), "symbol", "left_semi")
    after = F.coalesce(F.sum("rows").over(later), F.lit(0))
    return earlier.withColumn("after", after).filter(F.col("after") < lookback).select("symbol", _YEAR)


def warm_up(spark: SparkSession, root: str, new: DataFrame, year: int, last: versions.Commit) -> DataFrame:
    """Stored bars before ``year`` that the metrics of the new bars depend on.

    Only folders of years that some symbol needs are listed, and only needed (symbol, year) pairs go further.
    """
    if not [y for y in _years(last, COUNTS) if y < year]:
        return new.limit(0)
    needed = warm_years(read(spark, root, COUNTS), new, year)
    # One row a year of the calendar.
    years = [row[_YEAR] for row in needed.select(_YEAR).distinct().collect()]
    return read(spark, root, BARS, years).join(needed, ["symbol", _YEAR], "left_semi").select(new.columns)


def refresh(bars: DataFrame, since: date, root: str) -> versions.Commit:
    """Replace the stored bars from ``since`` on by ``bars``, and recompute the metrics of the years that changes.

    The year of ``since`` and those after it are written anew; its days before ``since`` are taken from the store.
    """
    spark, last = bars.sparkSession, _last(bars.sparkSession, root)
    new = bars.filter(F.col("trade_date") >= F.lit(since))
    if bars.filter(F.col("trade_date").isNull() | (F.col("trade_date") < F.lit(since))).limit(1).count():
        raise ValueError(f"there are bars before {since} or without a day")
    kept = read(spark, root, BARS, [since.year]).filter(F.col("trade_date") < F.lit(since)).select(new.columns)
    return _store(spark, root, kept.unionByName(new), since.year, last)


def metrics_since(spark: SparkSession, root: str, since: date) -> DataFrame:
    """Metrics from ``since`` on computed from the stored bars, reading only the years that they depend on."""
    last = _last(spark, root)
    recent = read(spark, root, BARS, [y for y in _years(last, BARS) if y >= since.year])
    rows = warm_up(spark, root, recent, since.year, last).unionByName(recent).drop(_YEAR)
    return daily_metrics(rows).filter(F.col("trade_date") >= F.lit(since))


def stored_summary(spark: SparkSession, root: str) -> DataFrame:
    """The summary of every symbol, merged from the stored parts: no metrics are read."""
    return merged_summary(read(spark, root, PARTS))
