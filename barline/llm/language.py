"""Language identification by a convolutional network over bytes, trained and applied in numpy.

A text is cut into windows of ``WINDOW`` bytes that cover it whole. Bytes are embedded, filters of
several widths slide over the window byte by byte, each filter's largest response is
kept, and a softmax layer gives the languages. The windows' log-probabilities are
added up, damped by the root of their number since neighbours are no independent evidence. All windows of a batch go through one matrix product.

How certain the windows of a text are on average, whichever language each is for, does not sharpen with its length. Texts in a language
that was not learned leave single windows undecided; what labelled texts set aside from training reach tells how little is too little.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, functions as F

from barline.llm.components import stored
from barline.llm.text import utf8

WINDOW = 96
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
UNKNOWN = "und"
# Documented bounds of the fitted classifier: texts of each language, windows of a text, and texts in all, which are dealt
# evenly where there are more languages than they suffice for.
TRAINING_TEXTS = 600
TRAINING_WINDOWS = 6
ALL_TRAINING_TEXTS = 60_000
EPOCHS = 6
# One text in so many is set aside to measure certainty, if that makes at least so many; share of them that may fall below.
SET_ASIDE, LEAST_ASIDE = 5, 100
UNCERTAIN = 0.002
# Windows computed at once.
_CHUNK = 1_024
_LETTER = regex.compile(r"\p{L}")


def windows(data: bytes) -> np.ndarray:
    """Rows of ``WINDOW`` bytes that cover all of ``data``; the last one ends where it ends.

    Data shorter than a window is filled up with byte 0.
    """
    if len(data) < WINDOW:
        return np.frombuffer(data.ljust(WINDOW, b"\0"), np.uint8)[None]
    whole = np.frombuffer(data, np.uint8)
    n = len(data) // WINDOW
    rows = whole[: n * WINDOW].reshape(n, WINDOW)
    return np.vstack([rows, whole[-WINDOW:][None]]) if len(data) % WINDOW else rows


@dataclass
class ByteNetwork:
    """Weights of the network and its languages in order."""

    languages: list[str]
    embedding: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    output: np.ndarray
    offset: np.ndarray
    # Mean certainty of windows below which a text is of no learned language; 0 if too little was set aside to say.
    least_certain: float = 0.0

    @classmethod
    def fresh(cls, languages: list[str], rng: np.random.Generator) -> ByteNetwork:
        """Random weights; a filter narrower than the widest has zeros behind it."""
        n, widest = FILTERS * len(WIDTHS), max(WIDTHS)
        filters = rng.normal(0, 0.3, (widest * EMBEDDING, n)).astype(np.float32) * cls.shape_mask()
        return cls(
            languages,
            rng.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32),
            filters,
            np.zeros(n, np.float32),
            rng.normal(0, 0.1, (n, len(languages))).astype(np.float32),
            np.zeros(len(languages), np.float32),
        )

    @staticmethod
    def shape_mask() -> np.ndarray:
        widest = max(WIDTHS)
        mask = np.zeros((widest * EMBEDDING, FILTERS * len(WIDTHS)), np.float32)
        for k, width in enumerate(WIDTHS):
            mask[: width * EMBEDDING, k * FILTERS : (k + 1) * FILTERS] = 1
        return mask

    def _patches(self, rows: np.ndarray) -> np.ndarray:
        """Embedded bytes under the filters: (windows, places, widest filter x embedding)."""
        places = np.arange(0, WINDOW - max(WIDTHS) + 1)
        bytes_at = rows[:, places[:, None] + np.arange(max(WIDTHS))]
        return self.embedding[bytes_at].reshape(len(rows), len(places), -1)

    def log_probabilities(self, rows: np.ndarray) -> np.ndarray:
        out = np.empty((len(rows), len(self.languages)), np.float32)
        for at in range(0, len(rows), _CHUNK):
            patches = self._patches(rows[at : at + _CHUNK])
            flat = patches.reshape(-1, patches.shape[2]) @ self.filters
            pooled = np.maximum(flat.reshape(*patches.shape[:2], -1).max(axis=1) + self.bias, 0)
            out[at : at + _CHUNK] = _log_softmax(pooled @ self.output + self.offset)
        return out

    def gradients(self, rows: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of the mean cross-entropy, in the order of ``weights``."""
        patches = self._patches(rows)
        responses = patches @ self.filters
        best = responses.argmax(axis=1)
        raw = np.take_along_axis(responses, best[:, None], axis=1)[:, 0] + self.bias
        pooled = np.maximum(raw, 0)
        error = np.exp(_log_softmax(pooled @ self.output + self.offset))
        error[np.arange(len(rows)), labels] -= 1
        error /= len(rows)
        back = (error @ self.output.T) * (raw > 0)
        chosen = np.take_along_axis(patches, best[:, :, None], axis=1)
        filters = np.einsum("bfk,bf->kf", chosen, back, optimize=True) * self.shape_mask()
        into = (back[:, :, None] * self.filters.T[None]).reshape(len(rows), -1, max(WIDTHS), EMBEDDING)
        embedding = np.zeros_like(self.embedding)
        under = rows[np.arange(len(rows))[:, None, None], best[:, :, None] + np.arange(max(WIDTHS))]
        np.add.at(embedding, under.ravel(), into.reshape(-1, EMBEDDING))
        return embedding, filters, back.sum(0), pooled.T @ error, error.sum(0)

    def weights(self) -> tuple[np.ndarray, ...]:
        return self.embedding, self.filters, self.bias, self.output, self.offset


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def train(examples: Iterable[tuple[str, str]], seed: int = 7, epochs: int = EPOCHS, rate: float = 0.01) -> ByteNetwork:
    """Fit the network to (text, language) pairs by Adam; the order of the pairs does not matter."""
    pairs = sorted((lang, text) for text, lang in examples if text and _LETTER.search(text))
    languages = sorted({lang for lang, _ in pairs})
    rng = np.random.default_rng(seed)
    network = ByteNetwork.fresh(languages, rng)
    if len(languages) < 2:
        return network
    aside = pairs[::SET_ASIDE] if len(pairs) >= SET_ASIDE * LEAST_ASIDE else []
    learned = [p for i, p in enumerate(pairs) if i % SET_ASIDE] if aside else pairs
    number = {lang: i for i, lang in enumerate(languages)}
    rows, labels = [], []
    for lang, text in learned:
        cut = windows(utf8(text))
        if len(cut) > TRAINING_WINDOWS:
            cut = cut[np.linspace(0, len(cut) - 1, TRAINING_WINDOWS).astype(int)]
        rows.append(cut)
        labels += [number[lang]] * len(cut)
    x, y = np.concatenate(rows), np.array(labels)
    # Short texts are windows filled up with 0: show some of each language cut to a few words.
    picked = rng.random(len(x)) < 0.25
    short, short_y = x[picked].copy(), y[picked]
    keep = rng.integers(12, WINDOW, len(short))
    short[np.arange(WINDOW)[None] >= keep[:, None]] = 0
    x, y = np.concatenate([x, short]), np.concatenate([y, short_y])

    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in network.weights()]
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 256):
            part = order[at : at + 256]
            step += 1
            lr = rate * (0.5 ** (epoch / 2))
            for w, g, (m, v) in zip(network.weights(), network.gradients(x[part], y[part]), moments):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= lr * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    if aside:
        certain = [found[2] for found in predict(network, (text for _, text in aside))]
        network.least_certain = float(np.quantile(certain, UNCERTAIN))
    return network


def training_sample(
    docs: DataFrame, allowed: Column | None = None, text: str = "text", lang: str = "lang", bound: int = TRAINING_TEXTS
) -> list[tuple[str, str]]:
    """About ``bound`` texts of each language, chosen by a hash of the text; equal texts count once.

    ``allowed`` restricts the rows learned from. Every language is learned; with so many that ``bound`` texts of each are more than
    ``ALL_TRAINING_TEXTS``, each gets its even part of those.
    """
    rows = docs.filter(allowed) if allowed is not None else docs
    rows = rows.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter("lang is not null and text is not null")
    # Stored, so that its small size is known and texts are not moved to meet it.
    sizes = stored(rows.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    languages = sizes.count()
    if not languages:
        return []
    each = max(1, min(bound, ALL_TRAINING_TEXTS // languages))
    slots = 1 << 30
    chosen = F.pmod(F.xxhash64("text"), F.lit(slots)) < F.least(F.lit(1.0), F.lit(float(each)) / F.col("n")) * slots
    picked = rows.join(sizes, "lang").filter(chosen).select("lang", _spread("text").alias("text")).distinct()
    return [(r["text"], r["lang"]) for r in picked.toLocalIterator()]


def _spread(text: str) -> Column:
    """A long text's parts from which training windows are taken, evenly spaced."""
    length, part = F.char_length(text), 2 * WINDOW
    starts = [((length - part) * k / (TRAINING_WINDOWS - 1)).cast("int") + 1 for k in range(TRAINING_WINDOWS)]
    parts = F.concat(*(F.substr(F.col(text), s, F.lit(part)) for s in starts))
    return F.when(length > part * TRAINING_WINDOWS, parts).otherwise(F.col(text))


def identify(docs: DataFrame, network: ByteNetwork, text: str = "text", into: str = "language") -> DataFrame:
    """``docs`` with a struct of the language and its probability; no shuffle.

    Null texts and texts without a letter are ``und`` with score 0, as is everything if nothing was
    learned. ``certain`` is the mean of the windows' largest probabilities; compare it with the network's ``least_certain``.
    Rows keep their other columns and their number; equal texts get equal results; a column named as ``into`` is replaced.
    """

    @F.pandas_udf("struct<lang:string,score:double,certain:double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame(predict(network, texts), columns=["lang", "score", "certain"])

    return docs.withColumn(into, run.asNondeterministic()(F.col(text)))


def predict(network: ByteNetwork, texts: Iterable[str | None]) -> list[tuple[str, float, float]]:
    """Language, its probability, and the mean certainty of each text."""
    out: list[tuple[str, float, float]] = []
    held: list[tuple[int, np.ndarray]] = []
    size = 0
    for text in texts:
        out.append((UNKNOWN, 0.0, 0.0))
        if network.languages and text and _LETTER.search(text):
            held.append((len(out) - 1, windows(utf8(text))))
            size += len(held[-1][1])
            if size >= _CHUNK:
                _settle(network, held, out)
                held, size = [], 0
    _settle(network, held, out)
    return out


def _settle(network: ByteNetwork, held: list[tuple[int, np.ndarray]], out: list[tuple[str, float, float]]) -> None:
    if not held:
        return
    logs = network.log_probabilities(np.concatenate([rows for _, rows in held]))
    starts = np.cumsum([0, *(len(rows) for _, rows in held[:-1])])
    sizes = np.array([len(rows) for _, rows in held])
    means = _log_softmax(np.add.reduceat(logs, starts, axis=0) / np.sqrt(sizes)[:, None])
    certain = np.add.reduceat(np.exp(logs.max(axis=1)).astype(np.float64), starts) / sizes
    best = means.argmax(axis=1)
    for (at, _), k, row, sure in zip(held, best, means, certain):
        out[at] = network.languages[k], float(np.exp(row[k])), float(sure)
