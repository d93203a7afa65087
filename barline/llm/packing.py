"""Packing of documents into fixed windows, next to lexically similar ones.

Documents become tokens and are cut into full windows; only the rest of each, shorter than a window, is
packed. Rests are sorted into ranges by a signature of their telling tokens, so that similar ones meet in
one shard wherever they stand in the corpus. A shard is a bounded run of a range with its own BM25 inverted index, using token
frequencies over all documents. The first unused rest of a shard is the seed of a window; the index returns its
best unused neighbours, which fill the window greedily: those that fit whole first, then the best is
cut to fill the rest exactly, and its remainder goes back to the shard. What a shard leaves over opens the next; the
last tokens of a range become sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F

from barline.llm import vocabulary
from barline.llm.components import stored

WINDOW = 1024
END = 0
# Tokens a shard's index holds.
SHARD_TOKENS = 600_000
# BM25 parameters.
_K1, _B = 1.2, 0.75
# An index is trimmed when this share of the rests it holds is left; each time costs about as much as a few queries.
_TRIM = 0.85
# Tokens that this share of a shard's rests hold are scored by a row over all of them, at most five times the room of their postings.
_DENSE = 0.2
# Fixed value: the pre-tokenizer pattern of the byte-level vocabularies. The alternatives before the look-ahead stand in a group, which the
# expression engine runs as one automaton; ungrouped it tries them one by one at every token.
_PATTERN = r"""(?:'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+)|\s+(?!\S)|\s+"""
# Minima of a signature: the first brings rests together, the others order those that share it.
SIGNATURE = 3
# Tokens of one range, about: ranges are tasks, shards their working sets.
RANGE_TOKENS = 8_000_000


@lru_cache(maxsize=2)
def encoder(path: str) -> tiktoken.Encoding:
    """The vocabulary's encoder, equal to its own library's and several times as fast."""
    words = vocabulary.load(path)
    return tiktoken.Encoding("byte-level", pat_str=_PATTERN, mergeable_ranks=words.ids, special_tokens=words.special)


def token_ids(text: str | None, path: str = vocabulary.DEFAULT, end: int = END) -> np.ndarray:
    """Ids of a text with the closing id; null is empty."""
    ids = encoder(path).encode_to_numpy(text or "", allowed_special="all")
    return np.append(ids, np.uint32(end)).astype("<u4")


def checksum(ids: np.ndarray) -> int:
    """CRC-32 of ids as little-endian 32-bit numbers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())


_PIECES = pa.schema(
    [
        ("doc", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("crc", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("ids", pa.binary()),
    ]
)


def _cut(path: str, end: int, window: int, keep_ids: bool):
    """Full windows with their checksum, and the rest of each document with its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                rows = []
                part = batch.slice(at, 128)
                for doc, text in zip(part.column(0).to_pylist(), part.column(1)):
                    ids = token_ids(text.as_py(), path, end)
                    n = len(ids)
                    whole = n - n % window
                    for start in range(0, whole, window):
                        own = ids[start : start + window]
                        rows.append((doc, start, window, checksum(own), n, own.tobytes() if keep_ids else None))
                    if whole < n:
                        rest = ids[whole:]
                        rows.append((doc, whole, n - whole, None, n, rest.tobytes()))
                columns = list(zip(*rows)) or [()] * len(_PIECES)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PIECES)], schema=_PIECES)

    return run


def _race(weight: np.ndarray, held: np.ndarray, end: int) -> np.ndarray:
    """The place of each token in one weighted random order, telling tokens more often in front.

    The first of a rest's tokens is a weighted MinHash: two rests share it with a chance that grows with the weight of
    the tokens they share. The closing id, which all rests hold, and tokens of a single rest come last.
    """
    scrambled = (np.arange(1, len(weight) + 1, dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    scrambled = (scrambled ^ (scrambled >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    scrambled = (scrambled ^ (scrambled >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    uniform = ((scrambled >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)
    arrival = -np.log(uniform) / weight**2
    arrival[(held < 2) | (np.arange(len(weight)) == end)] = np.inf
    place = np.empty(len(weight), np.int64)
    place[np.argsort(arrival, kind="stable")] = np.arange(len(weight))
    return np.where(np.isinf(arrival), len(weight), place)


def signatures(rests: list[np.ndarray], race: np.ndarray) -> list[np.ndarray]:
    """By rank, the ``SIGNATURE`` first places among each rest's distinct tokens, filled up with the last place."""
    lengths = np.array([len(ids) for ids in rests])
    places = race[np.concatenate(rests)]
    ranks = []
    for _ in range(SIGNATURE):
        ranks.append(np.minimum.reduceat(places, np.cumsum(lengths) - lengths))
        places[places == np.repeat(ranks[-1], lengths)] = len(race)
    return ranks


def signature(ids: np.ndarray, race: np.ndarray) -> list[int]:
    """The signature of one rest."""
    return [int(rank[0]) for rank in signatures([ids], race)]


_SIGNED = [f"signature{k}" for k in range(SIGNATURE)]


def _sign(race: np.ndarray):
    """Rests with their signature in front."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rests = [np.frombuffer(value.as_buffer(), "<u4") for value in batch.column(3)]
            ranks = signatures(rests, race) if rests else [()] * SIGNATURE
            columns = [pa.array(rank, pa.int64()) for rank in ranks]
            yield pa.RecordBatch.from_arrays([*columns, *batch.columns], names=[*_SIGNED, *batch.schema.names])

    return run


_FREQUENCY = pa.schema([("token", pa.int64()), ("documents", pa.int64())])


def _count(size: int):
    """Rests that hold each token, added up by task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for value in batch.column(0):
                total[np.frombuffer(value.as_buffer(), "<u4")] += 1  # once a distinct token: repeated places are not added up
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], schema=_FREQUENCY)

    return run


class Rest:
    """What is left to pack of one document."""

    __slots__ = ("doc", "doc_tokens", "ids", "start")

    def __init__(self, doc: int | None, start: int, doc_tokens: int, ids: np.ndarray):
        self.doc, self.start, self.doc_tokens, self.ids = doc, start, doc_tokens, ids


class Shard:
    """A BM25 index over rests, from which seeds and their neighbours are drawn until used."""

    def __init__(self, rests: list[Rest], weight: np.ndarray):
        self.rests = rests
        self.unused = np.ones(len(rests), bool)
        self._weight = weight
        lengths = np.array([len(r.ids) for r in rests], dtype=np.float64)
        owner = np.repeat(np.arange(len(rests)), lengths.astype(np.int64))
        tokens = np.concatenate([r.ids for r in rests]).astype(np.int64)
        # Postings sorted by token, then rest, with the number of times.
        pairs, times = np.unique(tokens * len(rests) + owner, return_counts=True)
        self._owner = pairs % len(rests)
        token = pairs // len(rests)
        norm = _K1 * (1 - _B + _B * lengths / lengths.mean())
        self._score = weight[token] * times * (_K1 + 1) / (times + norm[self._owner])
        self._tokens, starts = np.unique(token, return_index=True)
        self._starts = np.append(starts, len(token))
        # The rests of the index: its owners are places in this list.
        self._rests = np.arange(len(rests))
        self._split()

    def _split(self) -> None:
        """Scores of tokens that many rests hold as rows over all rests; postings of a zero score and of those tokens go."""
        held = np.diff(self._starts)
        dense = np.flatnonzero(held >= _DENSE * len(self._rests))
        self._row = np.full(len(held), -1)
        self._row[dense] = np.arange(len(dense))
        self._rows = np.zeros((len(dense), len(self._rests)))
        for row, i in zip(self._rows, dense):
            own = slice(self._starts[i], self._starts[i + 1])
            row[self._owner[own]] = self._score[own]
        self._keep((self._score > 0) & np.repeat(self._row < 0, held))

    def _keep(self, kept: np.ndarray) -> None:
        """Drop the other postings."""
        self._starts = np.append(0, np.cumsum(kept))[self._starts]
        self._owner, self._score = self._owner[kept], self._score[kept]

    def _trim(self) -> None:
        """Take used rests out of the index when enough of them have come together; scores stay the same."""
        free = self.unused[self._rests]
        if free.sum() < _TRIM * len(free):
            self._keep(free[self._owner])
            self._owner = (np.cumsum(free) - 1)[self._owner]
            self._rows = self._rows.compress(free, axis=1)  # unlike an index, keeps each row in one piece
            self._rests = self._rests[free]

    def scores(self, seed: Rest) -> np.ndarray:
        """BM25 score of every rest for the seed's distinct tokens; 0 for used ones and those that share none."""
        self._trim()
        scores = np.zeros(len(self.rests))
        asked = np.zeros(len(self._weight), bool)
        asked[seed.ids] = True
        at = np.searchsorted(self._tokens, np.flatnonzero(asked))
        at = at[at < len(self._tokens)]
        rows = self._row[at]
        found = self._rows[rows[rows >= 0]].sum(axis=0)
        at = at[rows < 0]
        starts = self._starts[at]
        held = self._starts[at + 1] - starts
        # Places of the postings of all tokens, token after token.
        places = np.repeat(starts - np.cumsum(held) + held, held) + np.arange(held.sum())
        found += np.bincount(self._owner[places], self._score[places], len(found))
        scores[self._rests] = found
        scores[~self.unused] = 0
        return scores


def ranked(scores: np.ndarray, at_once: int = 64) -> Iterator[int]:
    """Places of all scores above 0, highest first, equal ones in order; sorted in steps, as few are asked for."""
    scores = scores.copy()
    while True:
        found = np.flatnonzero(scores > 0)
        if len(found) > at_once:
            least = np.partition(scores[found], len(found) - at_once)[len(found) - at_once]
            found = found[scores[found] >= least]
        if not len(found):
            return
        yield from found[np.lexsort((found, -scores[found]))].tolist()
        scores[found] = 0
        at_once *= 2


# Neighbours tried one by one, before the best of those that still fit whole are looked for at once.
_TRIED = 64


def fill(shard: Shard, window: int) -> Iterator[list[Rest]]:
    """Windows of exactly ``window`` tokens; what is left of ``shard.rests`` stays unused.

    Neighbours that fit whole come first, best first, as long as there are any; then the best other one is cut to what is left of
    the window. Rests that share nothing with the seed follow in order.
    """
    rests, unused = shard.rests, shard.unused
    lengths = np.array([len(r.ids) for r in rests])
    left = int(lengths[unused].sum())
    seed = 0
    while left >= window:
        while not unused[seed]:
            seed += 1
        unused[seed] = False
        parts, space = [rests[seed]], window - len(rests[seed].ids)
        scores = shard.scores(rests[seed])
        order = ranked(scores)
        skipped = []

        def take(i: int) -> int:
            unused[i] = False
            scores[i] = 0
            parts.append(rests[i])
            return len(rests[i].ids)

        for i in islice(order, _TRIED):
            if not space:
                break
            if lengths[i] <= space:
                space -= take(i)
            else:
                skipped.append(i)
        while space:
            fitting = np.where(lengths <= space, scores, 0)
            i = int(fitting.argmax())
            if not fitting[i]:
                break
            space -= take(i)
        following = chain(skipped, order)
        after = seed
        while space:
            i = next(following, None)
            if i is None:  # no neighbour is left: the next unused rest in order
                after += 1
                while not unused[after]:
                    after += 1
                i = after
            if not unused[i]:
                continue
            if len(rests[i].ids) <= space:
                space -= take(i)
                continue
            rest = rests[i]
            parts.append(Rest(rest.doc, rest.start, rest.doc_tokens, rest.ids[:space]))
            rests[i] = Rest(rest.doc, rest.start + space, rest.doc_tokens, rest.ids[space:])
            lengths[i] -= space
            space = 0
        left -= window
        yield parts


def _powers(rests: list[Rest], window: int) -> Iterator[list[Rest]]:
    """The last rests, fewer tokens than a window, as sequences of lengths that are powers of two."""
    total = sum(len(r.ids) for r in rests)
    queue = list(reversed(rests))
    size = window
    while total:
        while size > total:
            size //= 2
        parts, space = [], size
        while space:
            rest = queue.pop()
            parts.append(Rest(rest.doc, rest.start, rest.doc_tokens, rest.ids[:space]))
            if len(rest.ids) > space:
                queue.append(Rest(rest.doc, rest.start + space, rest.doc_tokens, rest.ids[space:]))
            space -= len(parts[-1].ids)
        total -= size
        yield parts


_PACKED = pa.schema(
    [
        ("doc", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("ids", pa.binary()),
    ]
)
_PACKED_DDL = (
    "doc long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
)


def _pack(weight: np.ndarray, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        first = None

        def rows(parts: list[Rest]) -> list[tuple]:
            nonlocal number
            # Odd ids: the even ones are those of full windows.
            sequence, offset, out = 2 * (first + number) + 1, 0, []
            for p in parts:
                n = len(p.ids)
                out.append((p.doc, p.start, n, checksum(p.ids), p.doc_tokens, sequence, offset, p.ids.tobytes()))
                offset += n
            number += 1
            return out

        def table(packed: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*packed)) or [()] * len(_PACKED)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PACKED)], schema=_PACKED)

        held: list[Rest] = []
        size = 0
        for batch in batches:
            part, *columns = (batch.column(i).to_pylist() for i in range(5))
            if part and first is None:
                first = part[0] << 33
            for doc, start, doc_tokens, ids in zip(*columns):
                held.append(Rest(doc, start, doc_tokens, np.frombuffer(ids, "<u4")))
                size += len(held[-1].ids)
                if size >= SHARD_TOKENS:
                    shard = Shard(held, weight)
                    yield table([row for parts in fill(shard, window) for row in rows(parts)])
                    held = [r for r, free in zip(shard.rests, shard.unused) if free]
                    size = sum(len(r.ids) for r in held)
        if held:
            shard = Shard(held, weight)
            packed = [row for parts in fill(shard, window) for row in rows(parts)]
            held = [r for r, free in zip(shard.rests, shard.unused) if free]
            yield table(packed + [row for parts in _powers(held, window) for row in rows(parts)])

    return run


def pack(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    path: str = vocabulary.DEFAULT,
    window: int = WINDOW,
    end: int = END,
    keep_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents: (key, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]).

    Each token lies in one piece; a sequence's pieces fill it without gaps from offset 0 to ``window``, or to a smaller power of two.
    Null and empty texts are the closing id alone. Repeated rows are packed each for itself; null keys too.
    ``window`` must be a power of two. With ``keep_ids`` pieces carry their ids as little-endian 32-bit numbers. Tokens
    are written once to the shared folder; only rests shorter than a window are shuffled.
    """
    if window & (window - 1):
        raise ValueError("window must be a power of two")
    texts = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    fields = "doc long, start long, length long, crc long, doc_tokens long, ids binary"
    pieces = stored(texts.mapInArrow(_cut(path, end, window, keep_ids), fields), "pieces")
    rests = pieces.filter("crc is null")
    size = vocabulary.load(path).size
    counted = rests.select("ids").mapInArrow(_count(size), "token long, documents long")
    frequency = counted.groupBy("token").agg(F.sum("documents").alias("n")).collect()  # one row a token of the vocabulary
    n, tokens = rests.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    held = np.zeros(size)
    held[[r["token"] for r in frequency]] = [r["n"] for r in frequency]
    weight = np.log1p((n - held + 0.5) / (held + 0.5))

    ranges = max(1, math.ceil(tokens / RANGE_TOKENS), min(docs.sparkSession.sparkContext.defaultParallelism, n // 500))
    fields = "".join(f"{name} long, " for name in _SIGNED) + "doc long, start long, doc_tokens long, ids binary"
    signed = rests.select("doc", "start", "doc_tokens", "ids").mapInArrow(_sign(_race(weight, held, end)), fields)
    # Every rest holds the closing id: sharing it says nothing.
    weight[end] = 0
    by = [*_SIGNED, "doc", "start"]
    ordered = signed.repartitionByRange(ranges, *by).sortWithinPartitions(*by)
    placed = ordered.select(F.spark_partition_id().alias("part"), "doc", "start", "doc_tokens", "ids")
    packed = placed.mapInArrow(_pack(weight, window), _PACKED_DDL)
    full = pieces.filter("crc is not null").select(
        "doc",
        "start",
        "length",
        F.col("crc").alias("ids_crc32"),
        "doc_tokens",
        (F.monotonically_increasing_id() * 2).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        "ids",
    )
    out = full.unionByName(packed).withColumnRenamed("doc", key)
    return out if keep_ids else out.drop("ids")
