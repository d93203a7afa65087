"""Bars from per-symbol JSON payloads, with bad payloads set aside.

A payload is the text a price source returned for one symbol: an array of records. One bad
payload costs only its symbol; one bad date costs only its row.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from barline.functions.scalars import read_fields
from barline.schema import LANDED

_FIELDS = [f for f in LANDED if f.name != "symbol"]


class NoDataError(RuntimeError):
    """There are no bars."""


def judged_records(payloads: DataFrame) -> DataFrame:
    """One row per record of a usable payload, with its typed fields and ``bad``, the set of those that could not be read; else one
    row with the payload's ``reason``.

    The payload is parsed once, as the first of two elements of an array whose second is the payload's own digest: text
    after the payload breaks the array or leaves the digest out of place. Records are first taken as variants by field, which tell a
    field that is missing from one that is null; a field counts as present when any record has it.
    """
    digest = F.md5("payload")
    parsed = F.try_parse_json(F.concat(F.lit("["), "payload", F.lit(',"'), digest, F.lit('"]')))
    pair = F.try_variant_get(F.col("parsed"), "$", "array<variant>")
    whole = (F.size("pair") == 2) & F.try_variant_get(F.col("pair")[1], "$", "string").eqNullSafe(digest)
    fields = f"struct<{','.join(f'`{f.name}`:variant' for f in _FIELDS)}>"
    read = (
        payloads.select("symbol", "payload", parsed.alias("parsed"))
        .withColumn("pair", pair)
        .withColumn("body", F.when(F.coalesce(whole, F.lit(False)), F.try_element_at("pair", F.lit(1))))
        .withColumn("items", F.try_variant_get("body", "$", "array<variant>"))
        .withColumn("records", F.transform("items", lambda x: F.try_variant_get(x, "$", fields)))
    )

    def absent(name: str) -> Column:
        return ~F.exists("records", lambda record: record[name].isNotNull())

    reason = (
        F.when(F.col("body").isNull(), "not_json")
        .when(F.col("items").isNull(), "not_array")
        .when(F.exists("records", lambda record: record.isNull()), "not_array")
        .when(F.size("records") == 0, "empty")
        .when(reduce(or_, (absent(field.name) for field in _FIELDS)), "missing_field")
    )
    judged = read.select("symbol", "records", reason.alias("reason"))
    # The outer explode keeps Spark from testing the reason below it, where the parse would be repeated.
    usable = F.when(F.col("reason").isNull(), F.col("records"))
    rows = judged.select("symbol", "reason", F.explode_outer(usable).alias("record"))
    kinds = {f.name: T.DateType() if f.name == "date" else f.dataType for f in _FIELDS}
    texts = {name: F.try_variant_get(F.col("record")[name], "$", "string") for name in kinds}
    return read_fields(rows, kinds, texts, ["symbol", "reason"]).select("symbol", "reason", *kinds, "bad")


def bars_of(judged: DataFrame) -> DataFrame:
    """Landed bars of judged records: those with a date.

    The rows of unusable payloads have none. A test of the reason would be moved below the explode, and the parse repeated there.
    """
    rows = judged.filter(F.col("date").isNotNull())
    return rows.select("symbol", *(F.col(f.name).cast(f.dataType).alias(f.name) for f in _FIELDS))


def rejected_of(judged: DataFrame) -> DataFrame:
    """(symbol, reason): payloads not used, rows dropped for ``bad_date``, and values lost for ``bad_value``."""
    own = F.when(F.col("date").isNull(), "bad_date").when(F.col("bad") != 0, "bad_value")
    # A filter on the reason itself would be moved below the reading of the fields, which it would repeat.
    reasons = judged.select("symbol", F.explode_outer(F.array(F.coalesce("reason", own))).alias("reason"))
    return reasons.filter(F.col("reason").isNotNull()).distinct()


def bars_from_payloads(payloads: DataFrame) -> DataFrame:
    """Landed bars of all usable payloads, in one pass over the table."""
    return bars_of(judged_records(payloads))


def quarantine(payloads: DataFrame) -> DataFrame:
    """What ``rejected_of`` says of the payloads; store ``judged_records`` to read the source once for both."""
    return rejected_of(judged_records(payloads))


def require_data(bars: DataFrame) -> DataFrame:
    """The bars, or ``NoDataError`` when there are none."""
    if bars.isEmpty():
        raise NoDataError("no bars to work on")
    return bars


def symbols_without_bars(universe: DataFrame, bars: DataFrame) -> DataFrame:
    """Symbols of the universe that no bar refers to.

    Bars are reduced to their symbols before the join, so a symbol with many bars weighs as
    much as one with a single bar.
    """
    return universe.select("symbol").join(bars.select("symbol").distinct(), "symbol", "left_anti")
