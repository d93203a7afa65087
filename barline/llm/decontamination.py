"""Benchmark passages in documents, by Wu-Manber search over words.

Patterns are windows of consecutive benchmark words. A shift table over blocks of two words says
how far the search may jump: a block that ends no pattern's first ``m`` words lets it skip, one that
does selects patterns by their last block, and direct comparison confirms them. All patterns of
one length form one table, so ``m`` is the whole window and ordinary text is passed nine
words at a time. Large benchmarks are searched in blocks of bounded size, one pass after the other: what a pass found is stored before the
next block is read, so a task holds the tables of one block, and a worker builds them once.
"""

from __future__ import annotations

import math
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from barline.llm.components import stored
from barline.llm.text import alnum_words, fresh

WINDOW = 10
# Benchmark text searched at once. Tables take about a hundred times as much in each Python worker.
BLOCK_BYTES = 1 << 20

Words = tuple[bytes, ...]
Patterns = dict[Words, list[str]]


class WuManber:
    """Search for word windows of one length."""

    def __init__(self, patterns: Patterns, length: int):
        self.length = length
        self._block = block = min(2, length)
        self._default = length - block + 1
        self._shift: dict[Words | bytes, int] = {}
        self._endings: dict[Words | bytes, list[tuple[Words, list[str]]]] = defaultdict(list)
        for words, items in patterns.items():
            for end in range(block, length + 1):
                key = self._key(words, end)
                self._shift[key] = min(self._shift.get(key, self._default), length - end)
            self._endings[self._key(words, length)].append((words, items))

    def _key(self, words: Sequence[bytes], end: int) -> Words | bytes:
        return (words[end - 2], words[end - 1]) if self._block == 2 else words[end - 1]

    def search(self, words: list[bytes]) -> Iterator[tuple[int, list[str]]]:
        """Start and items of every occurrence, overlapping ones included."""
        length, shift, default, pair = self.length, self._shift, self._default, self._block == 2
        at, n = length, len(words)
        while at <= n:
            key = (words[at - 2], words[at - 1]) if pair else words[at - 1]
            skip = shift.get(key, default)
            if skip:
                at += skip
                continue
            start = at - length
            for pattern, items in self._endings[key]:
                if words[start] == pattern[0] and tuple(words[start:at]) == pattern:
                    yield start, items
            at += 1


def windows(text: str | None, window: int = WINDOW) -> set[Words]:
    """Windows of an item: all of ``window`` words, or its words as one if it has fewer."""
    words = tuple(alnum_words(text))
    if not words:
        return set()
    return {words[i : i + window] for i in range(max(1, len(words) - window + 1))}


def _searchers(items: list[tuple[str, str]], window: int) -> list[WuManber]:
    by_length: dict[int, Patterns] = defaultdict(lambda: defaultdict(list))
    for item, text in items:
        for words in windows(text, window):
            by_length[len(words)][words].append(item)
    return [WuManber(patterns, length) for length, patterns in sorted(by_length.items())]


# The tables of the block that this worker searched last.
_built: tuple[str, list[WuManber]] | None = None


def _tables(name: str, items: list[tuple[str, str]], window: int) -> list[WuManber]:
    """The tables of a block, kept by a worker between tasks."""
    global _built
    if _built is None or _built[0] != name:
        _built = None
        _built = name, _searchers(items, window)
    return _built[1]


_FIELDS = "struct<n_words:long,starts:array<int>,ends:array<int>,items:array<string>>"


def _scan(items: list[tuple[str, str]], window: int) -> Callable[..., Column]:
    """Adds what one block of items hits to what earlier blocks have."""
    name = uuid.uuid4().hex

    @F.pandas_udf(_FIELDS)
    def scan(
        batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]],
    ) -> Iterator[pd.DataFrame]:
        searchers = _tables(name, items, window)
        for batch in batches:
            rows = []
            for text, starts, ends, before in zip(*batch):
                words = alnum_words(text)
                hits = [(s, s + m.length, ids) for m in searchers for s, ids in m.search(words)]
                names = {*before, *(i for _, _, ids in hits for i in ids)}
                spans = _joined([*zip(starts, ends), *((s, e) for s, e, _ in hits)])
                rows.append((len(words), [s for s, _ in spans], [e for _, e in spans], sorted(names)))
            yield pd.DataFrame(rows, columns=["n_words", "starts", "ends", "items"])

    return scan.asNondeterministic()


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """Items in blocks of about ``block_bytes``, one at a time on the driver."""
    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text")).dropna().distinct()
    size = rows.agg(F.sum(F.octet_length("text") + F.lit(64))).first()[0] or 0
    n = max(1, math.ceil(size / block_bytes))
    if n == 1:
        yield [tuple(row) for row in rows.collect()]
        return
    for k in range(n):
        yield [tuple(row) for row in rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k).collect()]


def benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    into: str = "hits",
    window: int = WINDOW,
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with a struct of ``n_words``, hit spans of words (``starts``, ``ends``) and ``items``.

    No shuffle and no size limit: each block of the benchmark is one more pass over the texts, and the passes but the last are stored.
    Spans are joined, ends
    exclusive. Null and empty texts have no words and no hits; items without words and null items or
    ids match nothing; an item repeated counts once. Rows keep their other columns and their number; a column named as ``into``
    is replaced.
    """
    nothing = F.array().cast("array<int>"), F.array().cast("array<int>"), F.array().cast("array<string>")
    before, out, found = nothing, docs, fresh("hits")
    for number, items in enumerate(_blocks(benchmark, item_id, item_text, block_bytes)):
        if number:
            out = stored(out, "hits")
            before = tuple(F.col(found)[name] for name in ("starts", "ends", "items"))
        out = out.withColumn(found, _scan(items, window)(F.col(text), *before))
    return out.withColumn(into, F.col(found)).drop(found)


def hit_words(hits: Column) -> Column:
    """Words inside any occurrence."""
    return F.aggregate(
        F.zip_with(hits["starts"], hits["ends"], lambda start, end: (end - start).cast("long")),
        F.lit(0).cast("long"),
        lambda total, length: total + length,
    )
