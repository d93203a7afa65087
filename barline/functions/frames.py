"""Trading-row windows, rolling statistics, and the passes that compute them.

All frames count rows of one symbol in date order, the current row included, and are valid
while still filling. Every window of an indicator uses the same partition and order, so a
whole chain costs one shuffle and one sort.

Spark evaluates a sliding frame by revisiting all of its rows, so a 252-row frame costs 252
updates per bar. Frames are therefore put together from blocks: ``lag`` picks up the rows of a short block, plain
columns make its statistics, and the next pass picks up those blocks that end 1, 2, ... block widths
earlier. Only additions are involved (no running total is subtracted), so nothing cancels.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import zip_longest
from operator import add

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

# Frames up to this many rows are evaluated as they are.
SHORT_FRAME = 32
# Cost of fetching one lagged block, in updates of a sliding frame.
LAG_COST = 4

Columns = Mapping[str, Column]


@dataclass(frozen=True)
class Pass:
    """Columns one pass over a symbol's sorted rows adds: windows, then plain columns from them.

    ``derived`` is a sequence of steps; a step may use the columns of the steps before it.
    """

    windows: Columns
    derived: tuple[Columns, ...] = ()


# The passes of an indicator, in order of dependence.
Passes = list[Pass]


def _merged(parts: Sequence[Columns]) -> dict[str, Column]:
    return {name: column for part in parts for name, column in part.items()}


def together(*indicators: Passes) -> Passes:
    """Run indicators side by side: their first passes become one, then their second, and so on."""
    none = Pass({})
    return [
        Pass(
            _merged([p.windows for p in level]),
            tuple(_merged(step) for step in zip_longest(*(p.derived for p in level), fillvalue={})),
        )
        for level in zip_longest(*indicators, fillvalue=none)
    ]


def run(df: DataFrame, passes: Passes) -> DataFrame:
    """Add the columns of all passes."""
    for one in passes:
        for columns in (one.windows, *one.derived):
            df = df.withColumns(dict(columns)) if columns else df
    return df


def then(passes: Passes, *steps: Columns) -> Passes:
    """Passes with more steps after the last one's."""
    *before, last = passes
    return [*before, Pass(last.windows, (*last.derived, *steps))]


def history(*keys: str) -> WindowSpec:
    """Rows of one series in date order."""
    return Window.partitionBy(*keys).orderBy("trade_date")


def last_rows(spec: WindowSpec, n: int) -> WindowSpec:
    """The current row and the ``n - 1`` rows before it."""
    return spec.rowsBetween(1 - n, Window.currentRow)


def previous(column: str, spec: WindowSpec) -> Column:
    return F.lag(column).over(spec)


def block_width(widths: Sequence[int]) -> int:
    """The common divisor of ``widths`` with the least work per row."""
    common = math.gcd(*widths)
    divisors = [d for d in range(1, common + 1) if common % d == 0]
    return min(divisors, key=lambda d: d + LAG_COST * sum(w // d - 1 for w in widths))


def _blocks(column: str, block: int, count: int, empty: float | int, spec: WindowSpec) -> list[Column]:
    """The block ending at this row and the ``count - 1`` before it; ``empty`` before the first row."""
    return [F.col(column)] + [F.lag(column, block * i, empty).over(spec) for i in range(1, count)]


def rolling_means(spec: WindowSpec, source: str, widths: Mapping[str, int]) -> Passes:
    """One rolling mean of ``source`` per entry of ``widths`` (name -> rows). NULLs are skipped."""
    short = {name: F.avg(source).over(last_rows(spec, n)) for name, n in widths.items() if n <= SHORT_FRAME}
    long = {name: n for name, n in widths.items() if n > SHORT_FRAME}
    if not long:
        return [Pass(short)]

    block = block_width(list(long.values()))
    frame = last_rows(spec, block)
    total, count = f"__{source}_total", f"__{source}_count"
    blocks = {total: F.coalesce(F.sum(source).over(frame), F.lit(0.0)), count: F.count(source).over(frame)}
    means = {
        name: F.try_divide(
            reduce(add, _blocks(total, block, n // block, 0.0, spec)),
            reduce(add, _blocks(count, block, n // block, 0, spec)),
        )
        for name, n in long.items()
    }
    return [Pass({**short, **blocks}), Pass(means)]


# Rows of the blocks that the frames of each pass are put together from: single rows, then blocks of the pass before. Longer first blocks
# would be read by fewer lags, but Java never compiles a method over 8,000 bytes, and all plain columns of a pass are one.
_BLOCKS = (1, 5, 50)


def earlier(source: str, rows: int) -> str:
    """The column of ``lagged`` that has the value so many rows earlier."""
    return f"__{source}_at_{rows}" if rows else source


def lagged(spec: WindowSpec, source: str, rows: int) -> dict[str, Column]:
    """The values of the last ``rows`` rows before this one."""
    return {earlier(source, k): F.lag(source, k).over(spec) for k in range(1, rows + 1)}


def rows_of_first_block(width: int) -> int:
    """The values, this row's included, that ``rolling`` asks for in its first pass."""
    return min(width, _BLOCKS[1])


def _level(width: int) -> int:
    """The pass, from 1, after which a frame's statistics are there."""
    return 1 + sum(width > b for b in _BLOCKS[1:])


def _pieces(width: int) -> list[tuple[int, int]]:
    """(rows, rows earlier) of the blocks that make up a frame."""
    block = _BLOCKS[_level(width) - 1]
    whole, rest = divmod(width, block)
    return [(block, block * i) for i in range(whole)] + ([(rest, block * whole)] if rest else [])


def _mean(total: Column, count: Column) -> Column:
    return F.coalesce(F.try_divide(total, count), F.lit(0.0))


def _squared(x: Column) -> Column:
    return x * x


def rolling(
    spec: WindowSpec,
    source: str,
    means: Mapping[str, int],
    deviations: Mapping[str, int] | None = None,
    made: Pass | None = None,
    counts: str | None = None,
) -> Passes:
    """Rolling means and population deviations of ``source`` (name -> rows). NULLs are skipped.

    ``made`` is a first pass that makes the source and its earlier values; without it the source is lagged. ``counts`` is a
    source that is NULL in the same rows and whose frames include these.
    """
    deviations = deviations or {}
    base = counts or source

    def n(width: int) -> str:
        return f"__{base}_count{width}"

    def total(width: int) -> str:
        return f"__{source}_total{width}"

    def squares(width: int) -> str:
        return f"__{source}_squares{width}"

    def needed(widths: set[int]) -> set[int]:
        """The frames themselves and all blocks they are put together from."""
        parts = {rows for w in widths if _level(w) > 1 for rows, _ in _pieces(w)}
        return widths | (needed(parts) if parts - widths else parts)

    squared = needed(set(deviations.values()))
    widths = squared | needed(set(means.values()))
    passes = []
    for level in range(1, _level(max(widths)) + 1):
        own = sorted(w for w in widths if _level(w) == level)
        windows: dict[str, Column] = {}
        steps: list[dict[str, Column]] = []
        if level == 1:
            first = made or Pass(lagged(spec, source, max(own) - 1))
            windows, steps = dict(first.windows), [dict(step) for step in first.derived]
            seen, value = f"__{source}_seen", f"__{source}_value"
            at = {k: F.col(earlier(source, k)) for k in range(max(own))}
            plain = {f"{value}{k}": F.coalesce(x, F.lit(0.0)) for k, x in at.items()}
            steps.append(plain | {f"{seen}{k}": x.isNotNull().cast("double") for k, x in at.items()})
            pieces = {w: [(f"{seen}{k}", f"{value}{k}", None) for k in range(w)] for w in own}
        else:
            pieces = {}
            for w in own:
                pieces[w] = []
                for rows, back in _pieces(w):
                    names = [n(rows), total(rows), squares(rows) if w in squared else None]
                    if back:
                        for i, name in enumerate(names):
                            if name:
                                names[i] = f"{name}_at_{back}"
                                windows[names[i]] = F.lag(name, back, 0.0).over(spec)
                    pieces[w].append(tuple(names))
        sums = {total(w): reduce(add, (F.col(t) for _, t, _ in pieces[w])) for w in own}
        if base == source:
            sums |= {n(w): reduce(add, (F.col(c) for c, _, _ in pieces[w])) for w in own}
        steps.append(sums)
        of = [w for w in own if w in squared]
        if of:
            middle = {w: f"__{source}_middle{w}" for w in of}
            steps.append({middle[w]: _mean(F.col(total(w)), F.col(n(w))) for w in of})

            def about(w: int, c: str, t: str, s: str | None) -> Column:
                """Squares about the frame's mean: those within the block plus those of the block's mean."""
                if s is None:
                    return F.col(c) * _squared(F.col(t) - F.col(middle[w]))
                return F.col(s) + F.col(c) * _squared(_mean(F.col(t), F.col(c)) - F.col(middle[w]))

            steps.append({squares(w): reduce(add, (about(w, *piece) for piece in pieces[w])) for w in of})
        out = {name: F.try_divide(F.col(total(w)), F.col(n(w))) for name, w in means.items() if w in own}
        out |= {name: F.sqrt(F.try_divide(F.col(squares(w)), F.col(n(w)))) for name, w in deviations.items() if w in own}
        steps.append(out)
        passes.append(Pass(windows, tuple(steps)))
    return passes
