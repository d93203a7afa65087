"""Alignment of two tokenizers' ids, with corpus-wide counts of linked pairs by external spill counting.

Both tokenizers cut the same bytes. Where tokens of both end at one byte, a group ends; every first-side token of a group is linked
with every second-side token of it. How many documents hold a pair of ids linked, and which is a first id's commonest partner, is
counted over the corpus without a table of all records in one place:

1. Documents are read in chunks of bounded size. A chunk's pair-document records are partitioned by radix of the first id, sorted by
   first id, then second, and spilled as zstd runs. A run names each pair once, with its records in number; which documents they
   come from stays with the chunk. So a pair that every document holds is one entry a run, not one record a document.
2. Runs of one radix are merged by a heap over their next first ids. All entries of a first id then lie together: their sums are the
   pairs' counts, the largest is the first id's maximum, and both stream back into arrays that run parallel to each run.
   No merge opens more than ``FAN_IN`` runs: more are merged in waves, whose results are merged again, and counts come back the same way.
3. What came back for a chunk meets its documents, which sum their own links.

Everything is dealt by (radix, wave) or by chunk, so each task's memory is bounded by chunk size, fan-in and the vocabularies.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import struct
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import groupby, repeat
from operator import itemgetter

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from barline.llm import vocabulary
from barline.llm.components import stored
from barline.llm.packing import encoder

SECOND = public_tokenizers.path("piece_bpe_32k.model")
# Tokens of both sides that a chunk's documents may have, unless one alone has more; and documents.
CHUNK_TOKENS, CHUNK_DOCUMENTS = 6_000_000, 8_000
# Partitions of the first ids, and runs that one merge opens.
RADICES, FAN_IN = 64, 256
# Marks ids of the second side in a group's tokens.
_SECOND_SIDE = np.uint32(1 << 31)
# Links of one group from which equal ids are put together before ids are paired.
_LARGE = 1 << 16


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays as one zstd frame."""
    parts = []
    for a in arrays:
        parts += [struct.pack("<2sq", a.dtype.str[1:].encode(), len(a)), np.ascontiguousarray(a).tobytes()]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def unpacked(frame: bytes) -> list[np.ndarray]:
    content = zstandard.ZstdDecompressor().decompress(frame)
    arrays, at = [], 0
    while at < len(content):
        kind, n = struct.unpack_from("<2sq", content, at)
        dtype = np.dtype("<" + kind.decode())
        arrays.append(np.frombuffer(content, dtype, n, at + 10))
        at += 10 + n * dtype.itemsize
    return arrays


class Pair:
    """Two tokenizers of one text: byte-level merges over space and text, and pieces that add the space themselves."""

    def __init__(self, first: str, second: str):
        self._first = encoder(first)
        self._second = sentencepiece.SentencePieceProcessor(model_file=second)
        ids = vocabulary.load(first).ids
        self._first_bytes = [b""] * (max(ids.values()) + 1)
        for token, i in ids.items():
            self._first_bytes[i] = token
        pieces = range(self._second.get_piece_size())
        self._second_bytes = [
            bytes([int(self._second.id_to_piece(i)[3:-1], 16)])
            if self._second.is_byte(i)
            else self._second.id_to_piece(i).replace("▁", " ").encode()
            for i in pieces
        ]
        self._first_sizes = np.array([len(b) for b in self._first_bytes], np.int64)
        self._second_sizes = np.array([len(b) for b in self._second_bytes], np.int64)

    def ids(self, texts: Sequence[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of both sides; none where the joined bytes of either differ from space and text."""
        none = np.zeros(0, np.uint32)
        for text, second in zip(texts, self._second.encode(list(texts), num_threads=1)):
            if not text:
                yield none, none
                continue
            first = self._first.encode_to_numpy(f" {text}", allowed_special=set(), disallowed_special=())
            content = f" {text}".encode()
            same = content == b"".join(map(self._first_bytes.__getitem__, first.tolist()))
            same = same and content == b"".join(map(self._second_bytes.__getitem__, second))
            yield (first.astype(np.uint32), np.array(second, np.uint32)) if same else (none, none)

    def groups(self, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of both sides in order of their groups, the first side's before the second's, and where groups end."""
        ends = np.cumsum(self._first_sizes[first]), np.cumsum(self._second_sizes[second])
        common = np.intersect1d(*ends, assume_unique=True)
        last = [np.searchsorted(e, common) + 1 for e in ends]
        held = [np.diff(at, prepend=0) for at in last]
        tokens = np.empty(len(first) + len(second), np.uint32)
        # A token stands behind all of its own side before it and those of the other side in earlier groups (or its own).
        tokens[np.arange(len(first)) + np.repeat(last[1] - held[1], held[0])] = first
        tokens[np.arange(len(second)) + np.repeat(last[0], held[1])] = second | _SECOND_SIDE
        return tokens, last[0] + last[1]


@lru_cache(maxsize=2)
def pair(first: str, second: str) -> Pair:
    """The tokenizers, kept by a worker between tasks."""
    return Pair(first, second)


class _Numbers(dict):
    """Numbers of what is asked for, in order of first asking."""

    def __missing__(self, key: bytes) -> int:
        number = self[key] = len(self)
        return number


def _links(sides: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (group, pair) of groups given as ids of both sides, in order, with the number of links of each."""
    numbers, keys, times = [], [], []
    small = [i for i, (a, b) in enumerate(sides) if len(a) * len(b) < _LARGE]
    if small:
        n_a = np.array([len(sides[i][0]) for i in small])
        n_b = np.array([len(sides[i][1]) for i in small])
        # Each first-side token once for every token of the other side, and those counted through beside it.
        reps = np.repeat(n_b, n_a)
        starts = np.repeat(np.cumsum(n_b) - n_b, n_a)
        within = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
        a = np.repeat(np.concatenate([sides[i][0] for i in small]).astype(np.int64), reps)
        b = np.concatenate([sides[i][1] for i in small]).astype(np.int64)[np.repeat(starts, reps) + within]
        number = np.repeat(np.array(small), n_a * n_b)
        order = np.lexsort((b, a, number))
        number, key = number[order], (a << 32 | b)[order]
        new = np.flatnonzero(np.concatenate([[True], (np.diff(number) != 0) | (np.diff(key) != 0)]))
        numbers.append(number[new])
        keys.append(key[new])
        times.append(np.diff(new, append=len(key)))
    for i, (a, b) in enumerate(sides):
        if len(a) * len(b) >= _LARGE:
            (a, n_a), (b, n_b) = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
            keys.append((a.astype(np.int64)[:, None] << 32 | b.astype(np.int64)[None]).ravel())
            times.append((n_a[:, None] * n_b[None]).ravel())
            numbers.append(np.full(len(keys[-1]), i))
    number, key, time = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (numbers, keys, times))
    order = np.argsort(number, kind="stable")
    return number[order], key[order], time[order]


class Chunk:
    """Documents whose groups, pairs and records are counted together."""

    def __init__(self) -> None:
        self._groups = _Numbers()
        self._rows: list[tuple[int | None, int, int, list[int]]] = []
        self.tokens = 0

    def __len__(self) -> int:
        return len(self._rows)

    def add(self, doc: int | None, tokens: np.ndarray, ends: np.ndarray, n_first: int) -> None:
        content, at = tokens.tobytes(), (ends * 4).tolist()
        numbers = [self._groups[content[a:b]] for a, b in zip([0, *at], at)]
        self._rows.append((doc, n_first, len(tokens) - n_first, numbers))
        self.tokens += len(tokens)

    def spilled(self) -> tuple[list[bytes], bytes]:
        """The runs by radix, and the documents: what they hold by group, what groups hold by pair, and their results so far."""
        sides = []
        for content in self._groups:
            tokens = np.frombuffer(content, np.uint32)
            cut = int((tokens < _SECOND_SIDE).sum())
            sides.append((tokens[:cut], tokens[cut:] ^ _SECOND_SIDE))
        names = [f"{','.join(map(str, a.tolist()))}|{','.join(map(str, b.tolist()))}" for a, b in sides]
        sizes = np.array([len(a) * len(b) for a, b in sides], np.int64)
        group, key, times = _links(sides)
        held = np.bincount(group, minlength=len(sides)).astype(np.int64)
        first = np.cumsum(held) - held

        # Pairs by radix, first id, second id; the order of the runs one after the other.
        pairs, place = np.unique(key, return_inverse=True)
        radix = (pairs >> 32) % RADICES
        order = np.argsort(radix, kind="stable")
        moved = np.empty(len(pairs), np.int64)
        moved[order] = np.arange(len(pairs))
        place, pairs, radix = moved[place], pairs[order], radix[order]

        counts = np.zeros(len(pairs), np.int64)
        results, groups, times_held = [], [], []
        for doc, n_first, n_second, numbers in self._rows:
            own, often = np.unique(np.array(numbers, np.int64), return_counts=True)
            n = held[own]
            at = np.repeat(first[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            counts[np.unique(place[at])] += 1
            digest = hashlib.sha256(";".join([names[i] for i in numbers]).encode()).digest() if numbers else bytes(32)
            results.append((doc, n_first, n_second, len(numbers), int(sizes[own] @ often), len(own), digest))
            groups.append(np.diff(own, prepend=0))
            times_held.append(often)
        runs = []
        bounds = np.searchsorted(radix, np.arange(RADICES + 1))
        for a, b in zip(bounds[:-1], bounds[1:]):
            runs.append(run_of(pairs[a:b], counts[a:b]) if b > a else b"")
        docs, *numeric, digests = zip(*results)
        body = packed(
            np.array([d or 0 for d in docs], np.int64),
            np.array([d is None for d in docs], np.uint8),
            *(np.array(x, np.int64) for x in numeric),
            np.frombuffer(b"".join(digests), np.uint8),
            np.concatenate(groups).astype(np.int32),
            np.concatenate(times_held).astype(np.int32),
            held.astype(np.int32),
            place.astype(np.int32),
            times.astype(np.int32),
        )
        return runs, body


def run_of(pairs: np.ndarray, counts: np.ndarray) -> bytes:
    """A run: pairs in order of first, then second id, and their counts."""
    return packed(np.diff(pairs >> 32, prepend=0).astype(np.int32), (pairs & 0xFFFFFFFF).astype(np.uint32), counts)


def entries(run: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First ids, second ids and counts of a run."""
    steps, second, counts = unpacked(run)
    return np.cumsum(steps.astype(np.int64)), second.astype(np.int64), counts


def merged(runs: Sequence[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[tuple[int, list, np.ndarray, np.ndarray, np.ndarray]]:
    """For each first id of any run, by a heap over the runs: its parts (run, start, end), its second ids, where the parts' entries
    stand among them, and their counts."""

    def parts(number: int) -> Iterator[tuple[int, int, int, int]]:
        first = runs[number][0]
        starts = np.flatnonzero(np.concatenate([[True], np.diff(first) != 0])) if len(first) else np.zeros(0, np.int64)
        ends = np.append(starts[1:], len(first))
        return zip(first[starts].tolist(), repeat(number), starts.tolist(), ends.tolist())

    for first, found in groupby(heapq.merge(*map(parts, range(len(runs)))), itemgetter(0)):
        own = [part[1:] for part in found]
        second, place = np.unique(np.concatenate([runs[n][1][a:b] for n, a, b in own]), return_inverse=True)
        counts = np.zeros(len(second), np.int64)
        np.add.at(counts, place, np.concatenate([runs[n][2][a:b] for n, a, b in own]))
        yield first, own, second, place, counts


_RUNS_DDL = "radix int, run long, entries binary"
_COUNTED = pa.schema([("run", pa.int64()), ("radix", pa.int32()), ("counted", pa.binary())])
_COUNTED_DDL = "run long, radix int, counted binary"
_WAVE = pa.schema([("radix", pa.int32()), ("run", pa.int64()), ("entries", pa.binary())])


def _merge_wave(key: tuple, table: pa.Table) -> pa.Table:
    """The runs of a wave as one."""
    pairs, totals = [], []
    for first, _, second, _, counts in merged([entries(r) for r in table["entries"].to_pylist()]):
        pairs.append(first << 32 | second)
        totals.append(counts)
    run = run_of(np.concatenate(pairs), np.concatenate(totals))
    return pa.table([[key[0].as_py()], [key[1].as_py()], [run]], schema=_WAVE)


def _count(key: tuple, table: pa.Table) -> pa.Table:
    """Counts of all pairs of a radix, given back to each run: the count, and whether it is its first id's highest."""
    numbers = table["run"].to_pylist()
    runs = [entries(r) for r in table["entries"].to_pylist()]
    back = [(np.zeros(len(first), np.int64), np.zeros(len(first), np.uint8)) for first, _, _ in runs]
    for _, own, _, place, counts in merged(runs):
        of_entries = counts[place]
        highest = of_entries == counts.max()
        at = 0
        for n, a, b in own:
            back[n][0][a:b], back[n][1][a:b] = of_entries[at : at + b - a], highest[at : at + b - a]
            at += b - a
    return pa.table([numbers, [key[0].as_py()] * len(numbers), [packed(*arrays) for arrays in back]], schema=_COUNTED)


def _hand_down(key: tuple, table: pa.Table) -> pa.Table:
    """What came back for a merged run, given to the runs it was merged from."""
    rows = table.to_pylist()
    total, highest = unpacked(next(r["counted"] for r in rows if r["counted"] is not None))
    own = [(r["run"], entries(r["entries"])) for r in rows if r["entries"] is not None]
    keys = [first << 32 | second for _, (first, second, _) in own]
    pairs = np.unique(np.concatenate(keys))
    places = [np.searchsorted(pairs, k) for k in keys]
    frames = [packed(total[at], highest[at]) for at in places]
    return pa.table([[n for n, _ in own], [key[0].as_py()] * len(own), frames], schema=_COUNTED)


def _counted(runs: DataFrame, number: int) -> DataFrame:
    """(run, radix, counted) of ``number`` runs by radix; at most ``FAN_IN`` are opened together."""
    if number <= FAN_IN:
        return runs.groupBy("radix").applyInArrow(_count, _COUNTED_DDL)
    # A hash deals the runs about evenly: waves are planned half full.
    waves = math.ceil(2 * number / FAN_IN)
    dealt = runs.withColumn("wave", F.pmod(F.xxhash64("run"), F.lit(waves)))
    upper = stored(dealt.groupBy("radix", "wave").applyInArrow(_merge_wave, _RUNS_DDL), "waves")
    above = _counted(upper, waves).select("radix", F.col("run").alias("wave"), "counted")
    lower = dealt.withColumn("counted", F.lit(None).cast("binary"))
    return lower.unionByName(above, allowMissingColumns=True).groupBy("radix", "wave").applyInArrow(_hand_down, _COUNTED_DDL)


_SPILLED = pa.schema([("run", pa.int64()), ("radix", pa.int32()), ("entries", pa.binary()), ("body", pa.binary())])
_SPILLED_DDL = "run long, radix int, entries binary, body binary"


def _spill(first: str, second: str):
    """Runs and documents of each chunk; a run has its chunk's number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(first, second)
        task, made = TaskContext.get().partitionId(), 0
        chunk = Chunk()

        def rows() -> pa.RecordBatch:
            runs, body = chunk.spilled()
            number = task << 32 | made
            some = [i for i, r in enumerate(runs) if r]
            columns = [
                [number] * (len(some) + 1),
                [*some, None],
                [*(runs[i] for i in some), None],
                [None] * len(some) + [body],
            ]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SPILLED)], schema=_SPILLED)

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                texts = [t or "" for t in part.column(1).to_pylist()]
                for doc, (a, b) in zip(part.column(0).to_pylist(), both.ids(texts)):
                    if len(chunk) and (chunk.tokens + len(a) + len(b) > CHUNK_TOKENS or len(chunk) >= CHUNK_DOCUMENTS):
                        yield rows()
                        chunk, made = Chunk(), made + 1
                    chunk.add(doc, *both.groups(a, b), len(a))
        if len(chunk):
            yield rows()

    return run


_RESULT = pa.schema(
    [
        ("doc", pa.int64()),
        *((n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")),
        ("groups_sha256", pa.string()),
    ]
)
_RESULT_DDL = (
    "doc long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive parts of the given sizes, 0 for empty ones."""
    running = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return running[ends] - running[ends - sizes]


def _gather(key: tuple, table: pa.Table) -> pa.Table:
    """Results of a chunk's documents from what came back for its runs."""
    rows = table.to_pylist()
    body = next(r["body"] for r in rows if r["body"] is not None)
    docs, null, n_a, n_b, n_groups, n_links, own, digests, steps, often, held, place, times = unpacked(body)
    back = [unpacked(r["counted"]) for r in sorted((r for r in rows if r["body"] is None), key=itemgetter("radix"))]
    count = np.concatenate([b[0] for b in back]) if back else np.zeros(0, np.int64)
    best = np.concatenate([b[1] for b in back]) if back else np.zeros(0, np.uint8)
    groups = np.cumsum(steps.astype(np.int64))
    # Numbers of groups are stored as steps within each document.
    starts = np.cumsum(own) - own
    before = np.concatenate([[0], groups])[starts]
    groups -= np.repeat(before, own)
    often = often.astype(np.int64)
    sums, bests = (_sums(v[place] * times.astype(np.int64), held.astype(np.int64)) for v in (count, best.astype(np.int64)))
    hexes = digests.tobytes().hex()
    columns = [
        [None if empty else d for d, empty in zip(docs.tolist(), null)],
        *(x.tolist() for x in (n_a, n_b, n_groups, n_links)),
        _sums(bests[groups] * often, own).tolist(),
        _sums(sums[groups] * often, own).tolist(),
        [hexes[64 * i : 64 * i + 64] if n else "" for i, n in enumerate(n_groups)],
    ]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, _RESULT)], schema=_RESULT)


def align(docs: DataFrame, key: str = "doc_id", text: str = "text", first: str = vocabulary.DEFAULT, second: str = SECOND) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``docs``.

    ``first`` is a byte-level vocabulary, given space and text; ``second`` a piece model, which adds the space. Strings of special tokens
    are plain text. ``n_best`` counts links whose pair of ids has its first id's highest count, ties included; ``count_sum`` adds up
    the counts of all links. Null and empty texts, and texts that either side does not give back byte by byte, have no tokens: zeros and
    an empty digest. Each row is a document: repeated rows count each for itself, null keys too. Other columns are left out.
    """
    texts = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    spilled = stored(texts.mapInArrow(_spill(first, second), _SPILLED_DDL), "spilled")
    runs = spilled.filter("radix is not null").select("radix", "run", "entries")
    bodies = spilled.filter("radix is null").select("run", "body")
    number = spilled.filter("radix is null").count()
    counted = _counted(runs, number)
    together = bodies.unionByName(counted, allowMissingColumns=True)
    return together.groupBy("run").applyInArrow(_gather, _RESULT_DDL).withColumnRenamed("doc", key)
