"""CSV bars in and out."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from barline.operators.cleaning import sort_bars
from barline.operators.history import partitions_for
from barline.schema import LANDED, RAW

log = logging.getLogger(__name__)

CORRUPT = "_corrupt_record"
_TIMESTAMP = {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}


def read_bars_csv(
    spark: SparkSession, path: str, schema: T.StructType = LANDED, mode: str = "FAILFAST"
) -> DataFrame:
    """Bars from CSV files with a header; ``path`` may be a pattern over many files.

    Types come from ``schema``, never from inference, and the header is checked against it.
    ``FAILFAST`` stops at the first malformed row; ``PERMISSIVE`` keeps it with its text in an
    extra ``_corrupt_record`` column (see ``split_corrupt``). Spark parses only the columns a query
    uses, so a row counts as malformed only for those; a load uses them all.
    """
    if mode.upper() == "PERMISSIVE":
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(schema)
        .options(
            header=True,
            enforceSchema=False,
            mode=mode,
            columnNameOfCorruptRecord=CORRUPT,
            **_TIMESTAMP,
        )
        .csv(path)
    )


def split_corrupt(read: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good bars, malformed rows with their text) of a ``PERMISSIVE`` read."""
    data = [name for name in read.columns if name != CORRUPT]
    # Always true, but needs every column, so that each row is parsed whole whatever is selected
    # later: the reader's own setting for this leaves out what the query does not name.
    parsed = F.hash(*data) >= -(2**31)
    good = read.filter(parsed & F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, read.filter(parsed & F.col(CORRUPT).isNotNull())


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw bars as text from CSV files with a header, which is checked; no cell stops the read.

    Values in quotes may hold line breaks neither here nor in what ``write_bars_csv`` writes, so
    large files are split among tasks.
    """
    return spark.read.schema(RAW).options(header=True, enforceSchema=False, mode="PERMISSIVE").csv(path)


# Shuffle partitions from which Spark knows no preferred place for them, so that ``coalesce`` takes neighbours in order.
_UNPLACED = 1_000


def _in_files(bars: DataFrame, pieces: int, files: int) -> DataFrame:
    """Bars in order in ``files`` partitions, of which none sorts anything.

    Rows are sorted in many small ranges. Each range then moves as one run to a partition of its own, and every file's task reads
    its ranges one after the other, so its memory does not depend on the number of rows.
    """
    number = max(pieces, _UNPLACED)
    ordered = bars.repartitionByRange(pieces, "symbol", "date").sortWithinPartitions("symbol", "date")
    placed = ordered.withColumn("__place", F.floor(F.spark_partition_id().cast("long") * number / pieces).cast("int"))
    return placed.repartitionById(number, "__place").drop("__place").coalesce(files)


def write_bars_csv(bars: DataFrame, path: str, in_order: bool = False, files: int | None = None) -> bool:
    """Replace ``path`` with the bars as CSV; False, and nothing written, when there are none.

    ``in_order`` sorts all rows by symbol and date, within each file and from file to file. ``files`` sets how many files
    at most, and so how many writing tasks, there are; leave it out unless a reader needs it.
    """
    if bars.isEmpty():
        log.warning("no bars to write to %s", path)
        return False
    pieces = partitions_for(bars)
    if in_order and files and pieces > files:
        out = _in_files(bars, pieces, files)
    elif in_order and files:
        out = bars.repartitionByRange(files, "symbol", "date").sortWithinPartitions("symbol", "date")
    elif in_order:
        out = sort_bars(bars)
    else:
        out = bars.repartition(files) if files else bars
    out.write.mode("overwrite").options(header=True, **_TIMESTAMP).csv(path)
    return True
