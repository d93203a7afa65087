"""Quality rules: repetition and length, then divergence from the languages of the corpus.

Each language of the corpus gives two reference distributions, counted over all its documents:
classes of characters, and common words (those that make up at least ``COMMON`` of its words; the
rest counts as one). A document is compared with the language nearest to it by Jensen-Shannon
distance; that of words counts relative to a text without any common word. Short documents have ragged histograms, so each histogram counts only from a
minimum length on, and languages of too few documents are neither references nor judged.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from barline.llm.text import fresh, text_udf, utf8
from barline.session import scratch_path

WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
_SYMBOLS = "#*$%&|<>"
# A word is common if it is at least this share of its language's words, so at most 1,000 are.
COMMON = 0.001
# Documents from which on a language has a steady histogram and is a reference, however small its share.
LEAST_DOCUMENTS = 20
# Distances run from 0 (equal) to 1 (nothing in common).
MAX_CLASS_DISTANCE = 0.31
# Share of the distance of a text without any common word, by which a language's words may be missed.
MAX_WORD_SHARE = 0.95
# Shorter texts are not judged by the histogram.
CLASS_GUARD = 200  # bytes
WORD_GUARD = 50  # words

# Classes of UTF-8 bytes.
CLASSES = ("blank", "lower", "upper", "digit", "stop", "mark", "control", "beyond")


def _class_of(byte: int) -> int:
    char = chr(byte)
    if byte > 127:
        return 7
    if char in " \t\n\x0b\f\r":
        return 0
    if char.isalpha():
        return 1 if char.islower() else 2
    if char.isdigit():
        return 3
    if char in ".,;:'\"-!?()":
        return 4
    return 6 if byte < 32 or byte == 127 else 5


_CLASS = np.array([_class_of(b) for b in range(256)], dtype=np.uint8)
# Words a task counts before it passes its counts on.
_HELD = 300_000


@dataclass(frozen=True)
class References:
    """Distributions by language: classes, and shares of its common words with the rest last."""

    classes: dict[str, np.ndarray]
    words: dict[str, dict[bytes, float]]


def class_counts(data: bytes) -> np.ndarray:
    """Bytes of each class."""
    return np.bincount(_CLASS[np.frombuffer(data, np.uint8)], minlength=len(CLASSES))


def _plain_words(data: bytes) -> list[bytes]:
    return data.lower().translate(_PUNCTUATION).split()


_PUNCTUATION = bytes(32 if _class_of(b) in (4, 5, 6) else b for b in range(256))
_COUNT = pa.schema([("lang", pa.string()), ("kind", pa.int32()), ("key", pa.binary()), ("n", pa.int64())])


def references(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 1) -> References:
    """Count the reference distributions over all documents with a language that ``least`` documents have.

    Tasks pre-aggregate, one shuffle adds up; only common words and classes reach the driver,
    at most 1,000 words a language. Without any document there are no references.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        classes: dict[str, np.ndarray] = {}
        number: Counter = Counter()
        size = 0

        def flush() -> pa.RecordBatch:
            rows = [(name, 0, word, n) for name, words in held.items() for word, n in words.items()]
            rows += [(name, 1, str(k).encode(), int(n)) for name, c in classes.items() for k, n in enumerate(c)]
            rows += [(name, 2, b"", n) for name, n in number.items()]
            held.clear(), classes.clear(), number.clear()
            columns = list(zip(*rows)) or [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _COUNT)], schema=_COUNT)

        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = utf8(value.as_py())
                own = held.setdefault(name, Counter())
                size -= len(own)
                own.update(_plain_words(data))
                size += len(own)
                classes[name] = classes.get(name, 0) + class_counts(data)
                number[name] += 1
                if size >= _HELD:
                    yield flush()
                    size = 0
        yield flush()

    known = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).filter("lang is not null")
    counted = known.mapInArrow(count, "lang string, kind int, key binary, n long")
    # Stored, as it is read twice: first for totals, then for the words that are common by them.
    path = scratch_path(docs.sparkSession, "references")
    counted.groupBy("lang", "kind", "key").agg(F.sum("n").alias("n")).write.parquet(path)
    sums = docs.sparkSession.read.parquet(path)
    of_kind = [F.sum(F.when(F.col("kind") == k, F.col("n"))).alias(name) for k, name in ((0, "words"), (2, "documents"))]
    total = {r["lang"]: r["words"] or 0 for r in sums.groupBy("lang").agg(*of_kind).filter(F.col("documents") >= least).collect()}
    names = sorted(total)
    known = docs.sparkSession.createDataFrame([(n, float(total[n] * COMMON)) for n in names], "lang string, least double")
    own = sums.join(F.broadcast(known), "lang")  # one row a language, from the driver
    rows = own.filter((F.col("kind") == 1) | ((F.col("kind") == 0) & (F.col("n") >= F.col("least")))).collect()
    classes = {name: np.zeros(len(CLASSES)) for name in names}
    words: dict[str, dict[bytes, float]] = {name: {} for name in names}
    for r in rows:
        if r["kind"] == 1:
            classes[r["lang"]][int(r["key"])] = r["n"]
        else:
            words[r["lang"]][bytes(r["key"])] = r["n"] / total[r["lang"]]
    return References({n: c / c.sum() for n, c in classes.items() if c.sum()}, words)


def jensen_shannon(p: np.ndarray, q: np.ndarray) -> float:
    """Distance of two distributions: the root of their divergence to base 2."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        terms = np.where(p > 0, p * np.log2(p / m), 0.0) + np.where(q > 0, q * np.log2(q / m), 0.0)
    return float(np.sqrt(max(0.0, terms.sum() / 2)))


def class_distances(own: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Distance of a distribution from each row of ``columns``."""
    m = (own + columns) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        terms = np.where(own > 0, own * np.log2(own / m), 0.0) + np.where(columns > 0, columns * np.log2(columns / m), 0.0)
    return np.sqrt(np.maximum(0.0, terms.sum(axis=1) / 2))


class WordIndex:
    """Common words of all languages by word, so a text costs what it shares with them and not their number."""

    def __init__(self, words: dict[str, dict[bytes, float]]):
        # A language without a common word has nothing to compare.
        shares = [common for common in words.values() if common]
        self._size = len(shares)
        self._whole = np.array([sum(common.values()) for common in shares])
        self._rest = np.maximum(0.0, 1 - self._whole)
        self._place: dict[bytes, int] = {}
        entries = [(self._place.setdefault(w, len(self._place)), k, q) for k, c in enumerate(shares) for w, q in c.items()]
        place, language, share = (np.array(c) for c in zip(*entries)) if entries else [np.empty(0, np.int64)] * 3
        order = np.argsort(place, kind="stable")
        self._language, self._share = language[order], share[order]
        self._starts = np.searchsorted(place[order], np.arange(len(self._place) + 1))
        self.bare = self.distances({}, 1)

    def distances(self, counts: dict[bytes, int], n: int) -> np.ndarray:
        """Distance of a text of ``n`` words from each language; words that are not common in it are one bin."""
        found = [(self._place[w], k) for w, k in counts.items() if w in self._place]
        place, own = (np.array(c) for c in zip(*found)) if found else (np.empty(0, np.int64), np.empty(0))
        starts, lengths = self._starts[place], self._starts[place + 1] - self._starts[place]
        at = np.arange(lengths.sum()) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
        language, q, p = self._language[at], self._share[at], np.repeat(own / n, lengths)
        m = (p + q) / 2
        # A common word that the text lacks adds its whole share.
        met = p * np.log2(p / m) + q * np.log2(q / m) - q
        total = self._whole + np.bincount(language, met, self._size)
        p, q = np.maximum(0.0, 1 - np.bincount(language, p, self._size)), self._rest
        m = (p + q) / 2
        with np.errstate(divide="ignore", invalid="ignore"):
            total += np.where(p > 0, p * np.log2(p / m), 0.0) + np.where(q > 0, q * np.log2(q / m), 0.0)
        return np.sqrt(np.maximum(0.0, total / 2))


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that stand in the text twice or more."""
    n = len(words) - window + 1
    if n < 2 or len(set(words)) == len(words):
        return 0
    ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
    number = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
    key, classes = number[:n], len(ids)
    for k in range(1, window):  # renumbered after each word, so keys stay exact
        key, classes = key * len(ids) + number[k : k + n], 0
        _, key = np.unique(key, return_inverse=True)
    twice = np.bincount(key)[key] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    edges[: n] += twice
    edges[window : window + n] -= twice
    return int((np.cumsum(edges[:-1]) > 0).sum()) if len(at) else 0


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.encode().split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def quality(
    docs: DataFrame, text: str = "text", lang: str = "lang", into: str = "quality", known: References | None = None
) -> DataFrame:
    """``docs`` with a struct of counts, distances and the verdict ``kept``.

    Null texts are empty, and empty texts fail for having no words. Without a reference, and for documents of a
    language that is not one, the distances are null and do not count; documents without a language are compared with all. Rows keep their other columns and their number; a column named as ``into``
    is replaced; what is not known is counted first.
    """
    known = references(docs, text, lang, LEAST_DOCUMENTS) if known is None else known
    names = sorted(known.classes)
    columns = np.array([known.classes[name] for name in names])
    index = WordIndex({name: known.words[name] for name in names})

    def setup() -> Callable[[str | None], tuple]:
        def each(value: str | None) -> tuple:
            value = value or ""
            data = value.encode()
            words = data.split()
            n, repeated = len(words), repeated_words(words)
            failed = n < MIN_WORDS or 100 * repeated > MAX_REPEATED_PERCENT * n
            by_class = by_word = share = None
            if names and len(data) >= CLASS_GUARD:
                by_class = float(class_distances(class_counts(data) / len(data), columns).min())
            plain = _plain_words(data) if n >= WORD_GUARD else []
            if len(index.bare) and len(plain) >= WORD_GUARD:
                distances = index.distances(Counter(plain), len(plain))
                by_word, share = float(distances.min()), float((distances / index.bare).min())
            far = (by_class or 0) > MAX_CLASS_DISTANCE or (share or 0) > MAX_WORD_SHARE
            return (
                n,
                len(b"".join(words).decode()),
                sum(map(value.count, _SYMBOLS)),
                repeated_lines(value),
                repeated,
                failed,
                not failed,
                far,
                by_class,
                by_word,
            )

        return each

    fields = (
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
        "kept boolean, far boolean, class_distance double, word_distance double"
    )
    judged = F.col(lang).isNull() | F.col(lang).isin(names) if lang in docs.columns else F.lit(True)
    one = fresh(into)
    own = F.col(one)
    verdict = {"kept": own["kept"] & ~(judged & own["far"])}
    verdict |= {name: F.when(judged, own[name]) for name in ("class_distance", "word_distance")}
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    struct = F.struct(*(own[name].alias(name) for name in base), *(c.alias(name) for name, c in verdict.items()))
    return docs.withColumn(one, text_udf(fields, setup)(F.col(text))).withColumn(into, struct).drop(one)
