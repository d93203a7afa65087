"""From raw bars to typed, staged bars."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, functions as F

from barline.functions.scalars import read_fields, text_of
from barline.schema import LANDED, STAGED_FROM_LANDED


# Column of ``judged_bars`` with what could not be read.
REJECTED = "rejected"
_REJECTION = "array<struct<date:string,column_name:string,value:string,reason:string>>"


def judged_bars(raw: DataFrame) -> DataFrame:
    """Landed bars with ``rejected``: (date, column_name, value, reason) of every value that is there but none of its type, as written.

    One pass that reads each value once; store it to use both the bars (``bars_of``) and the rejections (``rejections_of``).
    """
    kinds = {f.name: f.dataType for f in LANDED}
    read = read_fields(raw, kinds, {name: F.col(name) for name in kinds})
    found = [
        F.when(
            F.col("bad").bitwiseAND(F.lit(1 << i)) != 0,
            F.struct(
                F.col(text_of("date")).alias("date"),
                F.lit(name).alias("column_name"),
                F.col(text_of(name)).alias("value"),
                F.lit("bad_date" if name == "date" else "bad_value").alias("reason"),
            ),
        )
        for i, name in enumerate(kinds)
        if name != "symbol"
    ]
    none = F.array().cast(_REJECTION)
    listed = F.when(F.col("bad") != 0, F.array_compact(F.array(*found))).otherwise(none)
    return read.select(*kinds, listed.alias(REJECTED))


def bars_of(judged: DataFrame) -> DataFrame:
    """The landed bars of judged ones."""
    return judged.select(*LANDED.names)


def rejections_of(judged: DataFrame) -> DataFrame:
    """(symbol, date, column_name, value, reason) of what judged bars reject.

    The outer form keeps Spark from testing the list's size below it, where all values would be read a second time.
    """
    return judged.select("symbol", F.inline_outer(REJECTED)).filter(F.col("reason").isNotNull())


def clean_bars(raw: DataFrame) -> DataFrame:
    """Landed types from raw bars: second-precision date (NULL if unreadable), no NaN.

    A value that cannot be read is NULL here; ``rejected_values`` lists it. Add ``sort_bars`` for the global sort, or
    leave rows unsorted and let the sink lay them out.
    """
    return bars_of(judged_bars(raw))


def rejected_values(raw: DataFrame) -> DataFrame:
    """(symbol, date, column_name, value, reason) of every value that cleaning cannot read.

    The reason is ``bad_date`` or ``bad_value``; empty cells and NaN are missing values, not bad ones.
    """
    return rejections_of(judged_bars(raw))


def sort_bars(bars: DataFrame) -> DataFrame:
    """Global order by symbol and date: a range shuffle, so a long symbol spans several tasks."""
    return bars.orderBy("symbol", "date")


def stage_bars(landed: DataFrame) -> DataFrame:
    """Rename to snake_case and keep the calendar date."""
    return landed.selectExpr(*(f"{expr} AS {name}" for name, expr in STAGED_FROM_LANDED.items()))


def staging_sql(landed_table: str) -> str:
    """The same projection as the text of a view."""
    columns = ", ".join(f"{expr} AS {name}" for name, expr in STAGED_FROM_LANDED.items())
    return f"SELECT {columns} FROM {landed_table}"


def date_range(landed: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """Landed bars from ``start`` to ``end``, both days included; an end left out is open.

    Compares the stored timestamp itself, so the filter reaches the file scan.
    """
    if start:
        landed = landed.filter(F.col("date") >= F.lit(start.isoformat()).cast("timestamp_ntz"))
    if end:
        after = (end + timedelta(days=1)).isoformat()
        landed = landed.filter(F.col("date") < F.lit(after).cast("timestamp_ntz"))
    return landed
