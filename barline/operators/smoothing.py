"""Exponential moving averages as a block scan of affine maps.

An exponential average ``y = (1 - a) y + a x`` is an affine map of the value before it, and maps compose. Each symbol's history is cut
into blocks of one calendar year, so a long history is spread over as many tasks as it has years. Within a block, running sums give
every row the map from the block's opening value to its own; the maps of whole blocks, one row each, are then
folded along a symbol in order, and each row applies its map to the value its block opens with.

With ``r = 1 - a`` and ``p`` prices so far in the block, the map is ``y = r^p (opening + sum a x r^-p)``. All terms are largest
where they are latest, so nothing cancels, and a year's powers stay far inside double range.

A first price is its own average. A row without a price keeps the value before it, which is NULL until there is a price.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from barline.operators.history import spread

# Name of the smoothed line, names of the averages it is the difference of, and its span.
Line = tuple[str, str, str, int]

_SERIES, _BLOCK, _SEEN, _PRICE = "__series", "__block", "__seen", "__price"
# Before every year: rows without a date come first in the order.
_UNDATED = -(2**31)


def _blocks(staged: DataFrame, price: str) -> DataFrame:
    """Prices by series and block. A series is a symbol, made safe for joins where it is NULL."""
    series = F.coalesce(F.concat(F.lit("="), "symbol"), F.lit(""))
    year = F.coalesce(F.year("trade_date"), F.lit(_UNDATED))
    rows = staged.select(series.alias(_SERIES), year.alias(_BLOCK), "trade_date", F.col(price).cast("double").alias(_PRICE))
    return spread(rows, _SERIES, _BLOCK)


def _decay(span: int) -> float:
    if span < 2:
        raise ValueError("a span must be 2 or more")
    return 1 - 2 / (span + 1)


def _power(decay: float) -> Column:
    """``decay`` to the number of prices so far in the block."""
    return F.pow(F.lit(decay), F.col(_SEEN))


def _with_maps(rows: DataFrame, spans: Mapping[str, int], line: Line | None) -> DataFrame:
    """Sums of the maps at every row: ``<name>_sum`` of each average, and those of the smoothed line.

    ``line`` = (name, fast, slow, span) is the average of ``fast - slow``. It depends on the openings of all three,
    linearly: ``<name>_fast`` and ``<name>_slow`` are what the two openings are multiplied by.
    """
    so_far = Window.partitionBy(_SERIES, _BLOCK).orderBy("trade_date").rowsBetween(Window.unboundedPreceding, 0)
    priced = F.col(_PRICE).isNotNull()

    def total(term: Column) -> Column:
        return F.coalesce(F.sum(F.when(priced, term)).over(so_far), F.lit(0.0))

    rows = rows.withColumn(_SEEN, F.count(_PRICE).over(so_far))
    sums = {f"{name}_sum": total((1 - _decay(n)) * F.col(_PRICE) / _power(_decay(n))) for name, n in spans.items()}
    rows = rows.withColumns(sums)
    if line is None:
        return rows
    name, fast, slow, span = line
    own, quick, calm = (_decay(n) for n in (span, spans[fast], spans[slow]))
    inside = _power(quick) * F.col(f"{fast}_sum") - _power(calm) * F.col(f"{slow}_sum")
    return rows.withColumns(
        {
            f"{name}_sum": total((1 - own) * inside / _power(own)),
            f"{name}_fast": total((1 - own) * _power(quick / own)),
            f"{name}_slow": total((1 - own) * _power(calm / own)),
        }
    )


def _applied(
    spans: Mapping[str, int], line: Line | None, value: Mapping[str, Column], at: Mapping[str, Column]
) -> dict[str, Column]:
    """The averages where the sums are ``at`` and the openings are ``value``."""

    def power(span: int) -> Column:
        return F.pow(F.lit(_decay(span)), at[_SEEN])

    out = {name: power(n) * (value[name] + at[f"{name}_sum"]) for name, n in spans.items()}
    if line is not None:
        name, fast, slow, span = line
        opened = value[fast] * at[f"{name}_fast"] - value[slow] * at[f"{name}_slow"]
        out[name] = power(span) * (value[name] + opened + at[f"{name}_sum"])
    return out


def _openings(maps: DataFrame, spans: Mapping[str, int], line: Line | None) -> DataFrame:
    """(series, block, __before, <opening of each average>): the blocks of a series folded in order.

    One row a block; a series has as many blocks as the calendar has years. ``__before`` says whether the history had a
    price before the block.
    """
    names = [*spans, *([line[0]] if line else [])]
    sums = [c for c in maps.columns if c not in (_SERIES, _BLOCK, "trade_date", _PRICE)]
    # The last row of a block has the sums of the whole block; they come in order after the window.
    last = F.max_by(F.struct(*sums), F.struct("trade_date", _SEEN))
    first = F.min_by(_PRICE, F.when(F.col(_PRICE).isNotNull(), F.struct("trade_date", _SEEN)))
    blocks = maps.groupBy(_SERIES, _BLOCK).agg(last.alias("last"), first.alias("first"))
    series = blocks.groupBy(_SERIES).agg(F.array_sort(F.collect_list(F.struct(_BLOCK, "last", "first"))).alias("blocks"))
    # An average opens at its first price; the line between two of them opens at 0.
    state = T.StructType([T.StructField(n, T.DoubleType()) for n in names])
    nothing = F.struct(*(F.lit(None).cast("double").alias(n) for n in names))

    def through(values: Column, block: Column) -> Column:
        """Openings so far with those of this block, and the values this block closes with."""
        begun = values["close"][names[0]].isNotNull()
        first = {n: block["first"] if n in spans else F.when(block["first"].isNotNull(), 0.0) for n in names}
        now = {n: F.when(begun, values["close"][n]).otherwise(first[n]) for n in names}
        close = _applied(spans, line, now, {s: block["last"][s] for s in sums})
        row = F.struct(block[_BLOCK].alias(_BLOCK), begun.alias("__before"), *(v.alias(n) for n, v in now.items()))
        closed = F.struct(*(close[n].alias(n) for n in names))
        return F.struct(F.concat(values["open"], F.array(row.cast(opening))).alias("open"), closed.cast(state).alias("close"))

    opening = T.StructType([T.StructField(_BLOCK, T.IntegerType()), T.StructField("__before", T.BooleanType()), *state.fields])
    start = F.struct(F.array().cast(T.ArrayType(opening)).alias("open"), nothing.cast(state).alias("close"))
    folded = F.aggregate("blocks", start, through, lambda values: values["open"])
    return series.select(_SERIES, F.inline(folded))


def exponential_averages(
    staged: DataFrame, spans: Mapping[str, int], price: str = "close", line: Line | None = None
) -> DataFrame:
    """(symbol, trade_date, one column a name): exponential averages of ``price`` over ``spans`` rows each.

    ``line`` = (name, fast, slow, span) adds the average of ``fast - slow``. Bars are shuffled once, by symbol and year; besides them
    only one row for each of those moves. Bars must be unique on (symbol, trade_date).
    """
    maps = _with_maps(_blocks(staged, price), spans, line)
    names = [*spans, *([line[0]] if line else [])]
    opened = _openings(maps, spans, line).withColumnsRenamed({n: f"__open_{n}" for n in names})
    joined = maps.join(opened, [_SERIES, _BLOCK])
    at = {c: F.col(c) for c in maps.columns}
    values = _applied(spans, line, {n: F.col(f"__open_{n}") for n in names}, at)
    # Within the block of the first price, rows before it have no value yet.
    begun = (F.col(_SEEN) > 0) | F.col("__before")
    symbol = F.when(F.col(_SERIES) != "", F.substring(_SERIES, 2, 2**31 - 1))
    return joined.select(
        symbol.alias("symbol"), "trade_date", *(F.when(begun, value).alias(name) for name, value in values.items())
    )
