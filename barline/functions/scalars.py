"""Scalar rules for NULL, zero and NaN, written once.

Spark differs from the warehouse dialect in three of them: a zero divisor raises under ANSI,
``ln`` of a non-positive number is not an error, and ``greatest`` skips NULLs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Quotient, NULL when the divisor is zero or NULL."""
    return F.try_divide(numerator, denominator)


def safe_ln(x: Column) -> Column:
    """Natural logarithm, NULL unless ``x`` is positive."""
    return F.when(x > 0, F.ln(x))


def positive_part(x: Column) -> Column:
    """``max(x, 0)`` that stays NULL when ``x`` is NULL."""
    return F.when(x.isNotNull(), F.greatest(x, F.lit(0.0)))


def nan_to_null(x: Column) -> Column:
    """NULL for NaN, which Spark would otherwise order above every number."""
    return F.when(~F.isnan(x), x)


def to_second(ts: Column) -> Column:
    """Drop the fraction of a second from a zone-less timestamp."""
    seconds = F.date_part(F.lit("SECOND"), ts)
    return ts - F.make_dt_interval(secs=seconds - F.floor(seconds))


def _read(text: Column, kind: T.DataType) -> Column:
    """A value read from text, but for what ``_finished`` does with it."""
    if isinstance(kind, T.LongType):
        exact = text.try_cast("decimal(38,10)")
        return F.coalesce(text.try_cast(kind), F.when(exact == F.floor(exact), exact).try_cast(kind))
    if isinstance(kind, T.DateType):
        # The calendar date as written, whatever the time of day.
        return text.try_cast("timestamp_ntz").cast(kind)
    return text.try_cast(kind)


def _finished(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampNTZType):
        return to_second(value)
    return nan_to_null(value) if isinstance(kind, T.DoubleType) else value


def typed(text: Column, kind: T.DataType) -> Column:
    """A value read from text, NULL if it is none of the type.

    Whole numbers may be written with a fraction of zero or an exponent (``11.0``, ``1e3``).
    Dates and times keep what is written, without the zone mark, to the second.
    """
    return _finished(_read(text, kind), kind)


def text_of(field: str) -> str:
    """The column of ``read_fields`` that has a field's text."""
    return f"__text_{field}"


def read_fields(
    df: DataFrame, kinds: Mapping[str, T.DataType], texts: Mapping[str, Column], keep: Sequence[str] = (), bad: str = "bad"
) -> DataFrame:
    """``keep``, each text (``text_of`` names it), its typed value, and ``bad``: a set of bits, the n-th where the n-th value is there but unreadable.

    Each value is read once: Spark does not compute a column anew in the next projection when that uses it more than once. Empty
    text and NaN count as no value.
    """
    text, value = {n: text_of(n) for n in kinds}, {n: f"__value_{n}" for n in kinds}
    out = df.select(*keep, *(texts[n].alias(text[n]) for n in kinds))
    out = out.withColumns({value[n]: _read(F.col(text[n]), kind) for n, kind in kinds.items()})
    out = out.select(*keep, *(F.col(c) for c in text.values()), *(_finished(F.col(value[n]), k).alias(n) for n, k in kinds.items()))
    found = [
        F.when(F.col(n).isNull() & ~missing(F.col(text[n])), F.lit(1 << i)).otherwise(F.lit(0)) for i, n in enumerate(kinds)
    ]
    return out.select(*keep, *(F.col(text[n]) for n in kinds), *kinds, reduce(Column.bitwiseOR, found).alias(bad))


def missing(text: Column) -> Column:
    """Whether there is no value: none, empty text, or NaN."""
    return text.isNull() | F.lower(F.trim(text)).isin("", "nan")
