"""Exact token counts at every prefix of a text, by dynamic programming over prefixes.

The byte-pair encoding of a string is the one sequence of tokens in which every two neighbours
are what the encoder makes of their concatenation. So the last token of a prefix is the one
suffix token that may follow the last token of the prefix before it, and

    tokens(prefix of i) = tokens(prefix of i - len(last)) + 1

gives the counts of all prefixes in one pass. Pre-tokenization cuts a text into pieces that are
encoded alone, and cutting a text short may change only its last piece; where the cut piece is no
prefix of the whole one (white space before a word, three-character contractions), it is counted
for itself. Units of white space and the word after it repeat, so a worker keeps their counts.
"""

from __future__ import annotations

import gc
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from operator import sub

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from barline.llm import vocabulary

# The white space of the byte-level pre-tokenizer, and its pattern.
_SPACE = " \t-\r\x85\xa0  -     　"
_PIECES = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+|"
    rf" ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
_LONG_CONTRACTIONS = ("'re", "'ve", "'ll")
_UNITS = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
_BLANKS = re.compile(f"[{_SPACE}]*")
# Up to here the Unicode tables of the regex library and the tokenizer agree; beyond, the tokenizer splits.
_OLD_LETTERS = re.compile("[\0-Ԁ]*")
# Units a worker remembers in each of two generations.
MEMORY = 300_000
# Characters of texts learned at once, and of the pieces that go through arrays; longer ones are counted alone.
_TEXT_CHUNK = 2_000_000
LONGEST_IN_BATCH = 48
_DELTA = np.dtype("h")


class _Lookup:
    """Numbers by 64-bit key in open addressing, for many keys at once."""

    def __init__(self, bits: int = 16):
        self._bits, self._number = bits, 0
        self._keys = np.zeros(1 << bits, np.uint64)
        self._values = np.full(1 << bits, -1, np.int32)

    def _places(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self._bits)).astype(np.int64)

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Distinct keys, none of them 0 or there already."""
        if 2 * (self._number + len(keys)) > len(self._keys):
            old = self._keys != 0
            keys, values = np.concatenate([self._keys[old], keys]), np.concatenate([self._values[old], values])
            self.__init__(max(self._bits + 1, int(4 * len(keys)).bit_length()))
        self._number += len(keys)
        places = self._places(keys)
        while len(keys):
            free = self._keys[places] == 0
            # Of several keys at one place the last written stays; the others go on.
            self._keys[places[free]] = keys[free]
            own = self._keys[places] == keys
            self._values[places[own]] = values[own]
            keys, values, places = keys[~own], values[~own], (places[~own] + 1) & (len(self._keys) - 1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Values of the keys, -1 where there is none."""
        places = self._places(keys)
        there = self._keys[places]
        out = np.where(there == keys, self._values[places], -1)
        on = np.flatnonzero((there != keys) & (there != 0))
        while len(on):
            places[on] = (places[on] + 1) & (len(self._keys) - 1)
            there = self._keys[places[on]]
            hit = there == keys[on]
            out[on[hit]] = self._values[places[on[hit]]]
            on = on[~hit & (there != 0)]
        return out


class _Batch:
    """The same dynamic programme for many short pieces side by side, a byte of each at a time."""

    _EXACT = 7  # bytes that fit into a key beside their number

    def __init__(self, tokens: list[bytes], may_follow: Callable[[bytes, bytes], bool]):
        self._tokens, self._may_follow = tokens, may_follow
        self._none = len(tokens)  # stands before the first token
        self._short, self._long, self._tails = _Lookup(), _Lookup(), _Lookup()
        self._pairs = _Lookup(20)
        width = max(map(len, tokens))
        spelled = np.zeros((len(tokens), width), np.uint8)
        for i, token in enumerate(tokens):
            spelled[i, width - len(token) :] = np.frombuffer(token, np.uint8)
        self._spelled = spelled
        sizes = np.array([len(t) for t in tokens])
        short = np.flatnonzero(sizes <= self._EXACT)
        self._short.add(self._key(spelled[short], sizes[short]), short.astype(np.int32))
        long = np.flatnonzero(sizes > self._EXACT)
        self._sizes_of_long = sorted(set(sizes[long].tolist()))
        tails = np.unique(self._key(spelled[long], np.full(len(long), self._EXACT)))
        self._tails.add(tails, np.ones(len(tails), np.int32))
        self._long.add(self._hash(spelled[long], sizes[long]), long.astype(np.int32))

    def _key(self, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Up to seven last bytes of each row, and how many they are."""
        key = sizes.astype(np.uint64) << np.uint64(56)
        for k in range(1, self._EXACT + 1):
            if k <= rows.shape[1]:
                own = rows[:, -k].astype(np.uint64) << np.uint64(8 * (k - 1))
                key |= np.where(sizes >= k, own, np.uint64(0))
        return key

    def _hash(self, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """A hash of the last bytes of each row; what it finds is compared byte by byte."""
        out = sizes.astype(np.uint64)
        for k in range(1, int(sizes.max(initial=0)) + 1):
            mixed = (out ^ rows[:, -k]) * np.uint64(0xBF58476D1CE4E5B9)
            out = np.where(sizes >= k, mixed ^ (mixed >> np.uint64(29)), out)
        return out | np.uint64(1)

    def _valid(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether each token may follow the one before."""
        keys = (before.astype(np.uint64) << np.uint64(32)) | (token.astype(np.uint64) + np.uint64(1))
        known = self._pairs.find(keys)
        if (known < 0).any():
            new = np.unique(keys[known < 0])
            spelled = [*self._tokens, b""]
            answers = [
                self._may_follow(spelled[int(k >> np.uint64(32))], spelled[int(k & np.uint64(0xFFFFFFFF)) - 1]) for k in new
            ]
            self._pairs.add(new, np.array(answers, np.int32))
            known = self._pairs.find(keys)
        return known == 1

    def deltas(self, pieces: list[str]) -> dict[str, bytes]:
        """Changes of the count with each character, by piece."""
        out: dict[str, bytes] = {}
        pieces = sorted(pieces, key=len, reverse=True)
        for at in range(0, len(pieces), 30_000):
            out.update(self._some(pieces[at : at + 30_000]))
        return out

    def _some(self, pieces: list[str]) -> Iterator[tuple[str, bytes]]:
        data = sorted(((p.encode(), p) for p in pieces), key=lambda x: -len(x[0]))
        lengths = np.array([len(d) for d, _ in data])
        width = int(lengths.max(initial=0))
        text = np.frombuffer(b"".join(d.ljust(width, b"\0") for d, _ in data), np.uint8).reshape(-1, width)
        last = np.full((len(data), width + 1), self._none, np.int32)
        counts = np.zeros((len(data), width + 1), np.int16)
        for end in range(1, width + 1):
            n = int(np.searchsorted(-lengths, -end, side="right"))  # the first n are long enough
            todo = np.arange(n)
            key = np.zeros(n, np.uint64)
            for size in range(1, min(end, self._EXACT) + 1):
                key |= text[todo, end - size].astype(np.uint64) << np.uint64(8 * (size - 1))
                found = self._short.find(key | np.uint64(size << 56))
                todo, key = self._settle(todo, key, found, end, size, last, counts)
                if not len(todo):
                    break
            if len(todo) and end > self._EXACT:
                todo = todo[self._tails.find(key | np.uint64(self._EXACT << 56)) == 1]
                for size in self._sizes_of_long:
                    if size > end or not len(todo):
                        break
                    rows = text[todo, end - size : end]
                    found = self._long.find(self._hash(rows, np.full(len(todo), size)))
                    same = (self._spelled[found, self._spelled.shape[1] - size :] == rows).all(axis=1)
                    todo, _ = self._settle(todo, todo, np.where(same, found, -1), end, size, last, counts)
        # Only counts at the end of a character are counts of a prefix.
        following = np.pad(text[:, 1:], ((0, 0), (0, 1)))
        places = np.arange(1, width + 1)
        ends = (places == lengths[:, None]) | ((places < lengths[:, None]) & (following & 0xC0 != 0x80))
        flat = counts[:, 1:][ends]
        number = ends.sum(axis=1)
        starts = np.cumsum(number) - number
        steps = np.diff(flat, prepend=flat[:1] * 0).astype(_DELTA)
        steps[starts] = flat[starts]
        stored = steps.tobytes()
        for (_, piece), start, n in zip(data, starts.tolist(), number.tolist()):
            yield piece, stored[2 * start : 2 * (start + n)]

    def _settle(self, todo, key, found, end, size, last, counts):
        """Write down the tokens that may stand there; the rows that still look for theirs."""
        some = np.flatnonzero(found >= 0)
        rows = todo[some]
        good = self._valid(last[rows, end - size], found[some])
        rows = rows[good]
        last[rows, end] = found[some[good]]
        counts[rows, end] = counts[rows, end - size] + 1
        left = np.ones(len(todo), bool)
        left[some[good]] = False
        return todo[left], key[left]


class PrefixCounter:
    """Token counts of all prefixes, for one byte-level vocabulary."""

    def __init__(self, path: str = vocabulary.DEFAULT):
        words = vocabulary.load(path)
        self._ids, self._ranks = words.ids, words.merge_rank
        self._made = {a + b: (rank, a, b) for (a, b), rank in self._ranks.items()}
        self._longest = max(map(len, self._ids))
        self._special = sorted(words.special)
        self._split = re.compile("|".join(map(re.escape, self._special))) if self._special else None
        self._pretokenizer = Tokenizer.from_file(path).pre_tokenizer
        self._follows: dict[tuple[bytes, bytes], bool] = {}
        self._pieces: dict[str, bytes] = {}
        self._known: dict[str, bytes] = {}
        self._before: dict[str, bytes] = {}
        self._batch = _Batch(list(self._ids), self._may_follow)

    def _merged(self, text: bytes) -> list[bytes]:
        """Plain byte-pair encoding of a short string."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            rank, at = min((self._ranks.get(pair, 1 << 60), i) for i, pair in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _neighbours(self, left: bytes, right: bytes) -> bool:
        """Whether encoding both together keeps the boundary between them.

        Undoes their merges from the latest on: a merge across the boundary would have come
        first if its rank is below the last one undone (or equal, when that lies to its right).
        """
        ranks, made = self._ranks, self._made
        limit = len(ranks)
        while True:
            if ranks.get((left, right), limit) < limit:
                return False
            by_left, by_right = made.get(left), made.get(right)
            if by_left is None and by_right is None:
                return True
            if by_right is None or (by_left is not None and by_left[0] > by_right[0]):
                limit, left = by_left[0], by_left[2]
            else:
                limit, right = by_right[0] + 1, by_right[1]

    def _may_follow(self, last: bytes, token: bytes) -> bool:
        answer = self._follows.get((last, token))
        if answer is None:
            if len(self._follows) >= 4 * MEMORY:
                self._follows.clear()
            answer = self._neighbours(last, token) if last else self._merged(token) == [token]
            self._follows[last, token] = answer
        return answer

    def _piece(self, piece: str) -> bytes:
        """Changes of the count with each character of one pre-tokenized piece."""
        known = self._pieces.get(piece)
        if known is None:
            counts = self._counts(piece)
            if piece in _LONG_CONTRACTIONS:  # cut short it is a mark and letters
                counts[1] = counts[0] + self._counts(piece[1])[0]
            known = self._pieces[piece] = array("h", map(sub, counts, [0, *counts])).tobytes()
        return known

    def _counts(self, piece: str) -> list[int]:
        """Tokens of each prefix of a piece, by character."""
        data = piece.encode()
        last: list[bytes] = [b""]
        counts = [0]
        ids, longest = self._ids, self._longest
        for end in range(1, len(data) + 1):
            for start in range(end - longest if end > longest else 0, end):
                token = data[start:end]
                if token in ids and self._may_follow(last[start], token):
                    last.append(token)
                    counts.append(counts[start] + 1)
                    break
        if len(data) == len(piece):
            return counts[1:]
        return [counts[i] for i in range(1, len(data) + 1) if i == len(data) or data[i] & 0xC0 != 0x80]

    def _split_unit(self, unit: str) -> list[str]:
        if _OLD_LETTERS.fullmatch(unit):
            return _PIECES.findall(unit)
        return [unit[a:b] for _, (a, b) in self._pretokenizer.pre_tokenize_str(unit)]

    def _unit(self, unit: str, pieces: list[str]) -> bytes:
        """Changes of the count with each character of white space and the word after it."""
        known = b"".join(map(self._piece, pieces))
        blanks = _BLANKS.match(unit).end()
        if 1 < blanks < len(unit):  # white space alone is one piece
            counts = np.cumsum(np.frombuffer(known, _DELTA), dtype=np.int64)
            counts[blanks - 1] = self._counts(unit[:blanks])[-1]
            known = np.diff(counts, prepend=0).astype(_DELTA).tobytes()
        return known

    def _learn(self, units: set[str]) -> None:
        """Count what is new among the units, all at once."""
        if len(self._known) >= MEMORY:
            # Units in use come back from the generation before at little cost.
            self._before, self._known = self._known, {}
            self._pieces.clear()
        before = self._before
        new = []
        for unit in units.difference(self._known):
            if unit in before:
                self._known[unit] = before[unit]
            else:
                new.append((unit, self._split_unit(unit)))
        pieces = {p for _, parts in new for p in parts}.difference(self._pieces, _LONG_CONTRACTIONS)
        self._pieces.update(self._batch.deltas([p for p in pieces if len(p) <= LONGEST_IN_BATCH]))
        for unit, parts in new:
            self._known[unit] = self._unit(unit, parts)

    def _deltas(self, text: str) -> bytes:
        """Changes of the count from character to character, for text without special tokens."""
        units = _UNITS.findall(text)
        self._learn(set(units))
        return b"".join(map(self._known.__getitem__, units))

    def many(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """``deltas`` of each text; what is new in all of them is counted at once."""
        plain = [None if self._is_special(t) else _UNITS.findall(t or "") for t in texts]
        self._learn(set().union(*filter(None, plain)))
        known = self._known
        found = [b"".join(map(known.__getitem__, units)) if units is not None else None for units in plain]
        for text, stored in zip(texts, found):
            yield self.deltas(text) if stored is None else np.frombuffer(stored, _DELTA)

    def _is_special(self, text: str | None) -> bool:
        return bool(text) and any(s in text for s in self._special)

    def deltas(self, text: str | None) -> np.ndarray:
        """Changes of the token count with each further character.

        A special token's string counts as one token, as by the library, once it is complete.
        """
        text = text or ""
        if not self._is_special(text):
            return np.frombuffer(self._deltas(text), _DELTA)
        done, at, total = [], 0, 0
        for found in [*self._split.finditer(text), None]:
            begin, end = found.span() if found else (len(text), len(text))
            # Until its last character a special token's string is ordinary text after the segment.
            counts = np.cumsum(np.frombuffer(self._deltas(text[at : max(begin, end - 1)]), _DELTA), dtype=np.int64)
            whole = int(counts[begin - at - 1]) if begin > at else 0
            if found:
                counts = np.append(counts, whole + 1)
            done.append(total + counts)
            total += whole + bool(found)
            at = end
        return np.diff(np.concatenate(done), prepend=0).astype(_DELTA)


class PrefixCounts:
    """The stored counts of one text; answers without encoding it again."""

    def __init__(self, stored: bytes):
        self._counts = np.cumsum(np.frombuffer(zlib.decompress(stored), _DELTA), dtype=np.int64)

    def __len__(self) -> int:
        return len(self._counts)

    def tokens(self, characters: int | None = None) -> int:
        """Tokens of the first ``characters`` characters, or of the whole text."""
        end = len(self._counts) if characters is None else characters
        return int(self._counts[end - 1]) if end else 0

    def characters_within(self, budget: int) -> int:
        """Length of the longest prefix of at most ``budget`` tokens."""
        return longest_within(self._counts, budget)


def longest_within(counts: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix of at most ``budget`` tokens; counts may fall, so look from the end."""
    if not len(counts) or counts[-1] <= budget:
        return len(counts)
    fits = np.flatnonzero(counts <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    """The counter with its memory, kept by a worker between tasks."""
    return PrefixCounter(path)


def token_counts(
    docs: DataFrame, budget: int, text: str = "text", into: str = "tokens", path: str = vocabulary.DEFAULT
) -> DataFrame:
    """``docs`` with a struct of ``n_tokens``, ``fitting_chars`` and ``prefixes``; no shuffle.

    ``prefixes`` stores the count at every prefix (see ``PrefixCounts``), ``fitting_chars`` the
    longest prefix within ``budget`` tokens. Null and empty texts have no tokens. Rows are handled one by
    one, so repeated rows give repeated results; other columns pass through untouched; a column named as ``into``
    is replaced. ``path`` must exist on every executor.
    """

    @F.pandas_udf("struct<n_tokens:long,fitting_chars:long,prefixes:binary>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counted = counter(path)
        # What is remembered is much and without cycles; looking through it for garbage costs a tenth of the time.
        gc.disable()
        try:
            yield from counts_of(counted, batches)
        finally:
            gc.enable()

    def counts_of(counted: PrefixCounter, batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows, part, size = [], [], 0
            for value in texts:
                part.append(value)
                size += len(value or "")
                if size >= _TEXT_CHUNK:
                    rows += map(answer, counted.many(part))
                    part, size = [], 0
            rows += map(answer, counted.many(part))
            yield pd.DataFrame(rows, columns=["n_tokens", "fitting_chars", "prefixes"], dtype=object)

    def answer(deltas: np.ndarray) -> tuple:
        counts = np.cumsum(deltas, dtype=np.int64)
        n = int(counts[-1]) if len(counts) else 0
        return n, longest_within(counts, budget), zlib.compress(deltas.tobytes(), 1)

    return docs.withColumn(into, run.asNondeterministic()(F.col(text)))
