"""Toxic passages: maximal scoring segments of words, calibrated by extreme values.

Every word gets its log-odds between toxic and other training documents under a Dirichlet prior.
The prior of a word is the class distribution of its opening letters, whose prior in turn is that of shorter
openings and at last of all words; words never seen are scored by their opening. A cost a word
makes ordinary text drift downwards, so that one linear scan (Ruzzo and Tompa) finds
all maximal scoring segments. The best score of chance segments in n words follows an extreme-value law

    P(best >= s) = 1 - exp(-K n exp(-lambda s))

whose two parameters are fitted to the best segments of training documents that are not toxic.
Segments rarer than ``SIGNIFICANT`` in a text of its length are reported; the expected number of
chance segments as good as the best one and the number of significant words give the score, by a logistic fit.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from itertools import compress

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from barline.llm.components import stored
from barline.llm.text import alnum_words, text_udf, utf8

# Letters of the openings that serve as priors, longest first.
OPENINGS = (6, 5, 4)
# Words' worth of prior that an opening gives a word, and that all words give an opening.
PRIOR = 2.0
# Openings must be seen in this many toxic documents, counted once for each of their words, before they speak for unseen words.
OPENING_DOCUMENTS = 8
# Words must be seen in this many for a score of their own.
WORD_DOCUMENTS = 3
# Least log-odds, less two standard errors, that a word or opening needs.
SURE = 1.5
# Score of an ordinary word; the expected score must be below 0 for the scan.
DRIFT = -0.5
CAP = 8.0
SIGNIFICANT = 0.01
# Training documents at most, of each class, and characters of all of them: documented bounds of the fitted classifier.
MAX_TRAINING = 6_000
MAX_TRAINING_CHARS = 100_000_000
# Words and openings kept by the model, those with the strongest evidence.
MAX_WORDS = 100_000

Segment = tuple[int, int, float]


def maximal_segments(scores: Sequence[float], positions: Sequence[int], drift: float) -> list[Segment]:
    """All maximal scoring segments: (start, end, score), in order.

    ``positions`` are those with a score of their own; words between them score ``drift``, which is
    below 0, so segments begin and end at positions. Each open segment knows the nearest one before it that begins at a smaller
    sum; the search goes from one to the next, never over the same one twice, so the scan is linear in their number.
    """
    stack: list[tuple[int, int, float, float, int]] = []  # start, end, sum before, sum through, nearest with a smaller sum before
    total, previous = 0.0, -1
    for position, score in zip(positions, scores):
        total += drift * (position - previous - 1)
        previous = position
        before, total = total, total + score
        if score <= 0:
            continue
        start, left, right = position, before, total
        k = len(stack) - 1
        while k >= 0:
            if stack[k][2] >= left:
                k = stack[k][4]
            elif stack[k][3] >= right:
                break
            else:
                start, left = stack[k][0], stack[k][2]
                following = stack[k][4]
                del stack[k:]
                k = following
        stack.append((start, position + 1, left, right, k))
    return [(start, end, right - left) for start, end, left, right, _ in stack]


@dataclass
class ToxicityModel:
    """Log-odds of words and openings, the extreme-value law and the logistic calibration."""

    words: dict[bytes, float] = field(default_factory=dict)
    openings: dict[str, float] = field(default_factory=dict)
    decay: float = 1.0
    scale: float = 1.0
    weights: tuple[float, ...] = (-3.0, 1.0, 1.0)

    def score(self, word: bytes) -> float:
        """Log-odds less the cost of a word."""
        odds = self.words.get(word)
        if odds is None:
            text = word.decode(errors="ignore")
            odds = next((self.openings[text[:n]] for n in OPENINGS if text[:n] in self.openings and len(text) >= n), 0.0)
        return max(-CAP, min(CAP, odds)) + DRIFT

    def expected(self, best: float, n: int) -> float:
        """Chance segments as good as ``best`` expected in ``n`` words."""
        return self.scale * max(1, n) * math.exp(-self.decay * best)

    def features(self, n: int, segments: list[Segment], hits: int) -> tuple[float, float]:
        best = max((s for _, _, s in segments), default=0.0)
        rarity = -math.log10(max(1e-12, min(1.0, self.expected(best, n)))) if best > 0 else 0.0
        return rarity, math.log1p(hits)

    def probability(self, features: tuple[float, float]) -> float:
        z = self.weights[0] + sum(w * x for w, x in zip(self.weights[1:], features))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


class Scanner:
    """Scores of words as a worker meets them, and the segments of a text."""

    def __init__(self, model: ToxicityModel, memory: int = 100_000):
        self._model, self._memory, self._known = model, memory, {}

    def segments(self, words: list[bytes]) -> list[Segment]:
        known = self._known
        if len(known) > self._memory:
            known.clear()
        for word in set(words).difference(known):
            known[word] = self._model.score(word)
        scores = list(map(known.__getitem__, words))
        own = [s != DRIFT for s in scores]
        return maximal_segments(list(compress(scores, own)), list(compress(range(len(words)), own)), DRIFT)

    def judged(self, text: str | None) -> tuple[int, list[Segment], tuple[float, float]]:
        """Words, significant segments and features of a text."""
        words = alnum_words(text)
        found = self.segments(words)
        significant = [s for s in found if self._model.expected(s[2], len(words)) < SIGNIFICANT]
        return len(words), significant, self._model.features(len(words), found, len(significant))


def _log_odds(toxic: float, other: float, prior: float, all_toxic: float, all_other: float) -> float:
    """Log ratio of the class rates; ``prior`` is the share of toxic among the prior's counts."""
    a = (toxic + PRIOR * prior) / all_toxic
    b = (other + PRIOR * (1 - prior)) / all_other
    return math.log(a / b)


def _learned(texts: Sequence[tuple[str | None, int]]) -> ToxicityModel:
    """Log-odds of words and openings; the law and the weights are those of a model without training."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    openings: tuple[Counter, Counter] = (Counter(), Counter())
    for value, label in texts:
        for word in set(alnum_words(value)):
            counts[label][word] += 1
            text = word.decode(errors="ignore")
            for opening in {text[:n] for n in OPENINGS if len(text) >= n}:
                openings[label][opening] += 1
    number = Counter(label for _, label in texts)
    model = ToxicityModel()
    if not number[0] or not number[1]:
        return model
    # Presence in documents is counted; with the class sizes as exposure the log-odds of an even word are 0.
    n1, n0 = float(number[1]), float(number[0])
    even = n1 / (n1 + n0)
    evidence: dict[bytes, tuple[float, float]] = {}
    strength: dict[str, tuple[float, float]] = {}
    for opening in sorted(openings[1], key=len):
        toxic, other = openings[1][opening], openings[0][opening]
        if toxic >= OPENING_DOCUMENTS:
            odds = _log_odds(toxic, other, even, n1, n0)
            strength[opening] = odds, odds - 2 * math.sqrt(1 / toxic + 1 / (other + PRIOR))
    for word in (w for w, n in counts[1].items() if n >= WORD_DOCUMENTS):
        toxic, other = counts[1][word], counts[0][word]
        text = word.decode(errors="ignore")
        opening = next((text[:n] for n in OPENINGS if len(text) >= n and text[:n] in strength), None)
        prior = even
        if opening is not None:
            a, b = openings[1][opening], openings[0][opening]
            prior = (a + PRIOR * even) / (a + b + PRIOR)
        odds = _log_odds(toxic, other, prior, n1, n0)
        evidence[word] = odds, odds - 2 * math.sqrt(1 / toxic + 1 / (other + PRIOR))
    # Only what is surely toxic scores above an ordinary word: the odds less two standard errors.
    keep = sorted((w for w in evidence if evidence[w][1] > SURE), key=lambda w: (-evidence[w][1], w))[:MAX_WORDS]
    model.words = {w: evidence[w][0] for w in keep}
    kept = sorted((o for o in strength if strength[o][1] > SURE), key=lambda o: (-strength[o][1], o))[:MAX_WORDS]
    model.openings = {o: strength[o][0] for o in kept}
    # Words known from other documents do not inherit their opening's score.
    for word, n in counts[0].items():
        if n >= WORD_DOCUMENTS and word not in model.words and model.score(word) != DRIFT:
            model.words[word] = 0.0
    return model


def fit(examples: Iterable[tuple[str | None, int]]) -> ToxicityModel:
    """Fit the model to (text, label) pairs; labels are 0 or 1.

    The law of chance segments comes from texts that the log-odds behind them have not seen: each half of the texts is scanned with
    what the other half teaches.
    """
    texts = [(text, int(label)) for text, label in examples]
    model = _learned(texts)
    if len({label for _, label in texts}) < 2:
        return model
    halves = [[pair for pair in texts if zlib.crc32(utf8(pair[0])) % 2 == half] for half in (0, 1)]
    chance = []
    for own, other in (halves, halves[::-1]):
        scanner = Scanner(_learned(other))
        for words in (alnum_words(text) for text, label in own if not label):
            chance.append((len(words), max((s for _, _, s in scanner.segments(words)), default=0.0)))
    _fit_extremes(model, chance)
    scanner = Scanner(model)
    judged = [(len(words), scanner.segments(words), label) for words, label in ((alnum_words(t), y) for t, y in texts)]
    _fit_calibration(model, judged)
    return model


def _fit_extremes(model: ToxicityModel, best: list[tuple[int, float]]) -> None:
    """Parameters of the extreme-value law by maximum likelihood, from the words and the best segment of chance texts.

    A text without a segment says that none reached the smallest score seen. For a decay the best scale is known,
    ``found / sum of n exp(-decay s)``; what is left falls with the decay and is 0 at the best one.
    """
    found = [(n, s) for n, s in best if s > 0 and n > 0]
    if len(found) < 20:
        # Ordinary texts hold next to no positive segment: the law of a score unit a natural log.
        model.decay = 1.0
        model.scale = (len(found) + 1) / (sum(n for n, _ in best) + 1)
        return
    least = min(s for _, s in found)
    n = np.array([n for n, _ in best if n > 0], float)
    s = np.array([max(s, least) for n, s in best if n > 0])
    total = sum(s for _, s in found)

    def slope(decay: float) -> float:
        weights = n * np.exp(-decay * (s - least))
        return len(found) / decay - total + len(found) * float(weights @ s / weights.sum())

    low, high = 0.05, 20.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if slope(middle) > 0 else (low, middle)
    model.decay = low
    model.scale = len(found) / float(n @ np.exp(-low * s))


def _fit_calibration(model: ToxicityModel, judged: list[tuple[int, list[Segment], int]]) -> None:
    """Logistic weights of the two features, by Newton steps with a small ridge."""
    rows, labels = [], []
    for n, found, label in judged:
        significant = sum(model.expected(s, n) < SIGNIFICANT for _, _, s in found)
        rows.append((1.0, *model.features(n, found, significant)))
        labels.append(label)
    x, y = np.array(rows), np.array(labels, dtype=float)
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-1 * np.eye(len(w)), x.T @ (y - p) - 1e-1 * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    model.weights = tuple(float(v) for v in w)


def training_sample(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", bound: int = MAX_TRAINING
) -> list[tuple[str | None, int]]:
    """At most about ``bound`` labelled texts of each class, and ``MAX_TRAINING_CHARS`` in all, chosen by a hash of the key.

    Only the chosen keys, whose number is bounded, are joined with the texts.
    """
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
    known = known.filter("key is not null and label in (0, 1)").distinct()
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    slots = 1 << 30

    def slot(seed: int) -> Column:
        return F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(slots))

    def chosen(value: int) -> Column:
        share = min(1.0, bound / max(1, sizes.get(value, 0)))
        return (F.col("label") == value) & (F.pmod(F.xxhash64("key"), F.lit(slots)) < int(share * slots))

    picked = known.filter(chosen(0) | chosen(1))
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    rows = stored(texts.join(F.broadcast(picked), "key"), "training")
    chars = rows.agg(F.sum(F.char_length("text"))).first()[0] or 0
    if chars > MAX_TRAINING_CHARS:
        rows = rows.filter(slot(1) < int(MAX_TRAINING_CHARS / chars * slots))
    return [(r["text"], r["label"]) for r in rows.select("text", "label").toLocalIterator()]


def toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text", into: str = "toxicity") -> DataFrame:
    """``docs`` with a struct of the score and the significant passages; no shuffle.

    ``passages`` gives the first word, the word after the last and the score of each. Null and empty texts have no
    passage and the score of a text without any. Rows keep their other columns and their number; a column named as ``into``
    is replaced.
    """

    def setup() -> Callable[[str | None], tuple]:
        scanner = Scanner(model)

        def each(value: str | None) -> tuple:
            n, found, features = scanner.judged(value)
            return n, model.probability(features), found

        return each

    fields = "n_words long, score double, passages array<struct<start:int,end:int,score:double>>"
    return docs.withColumn(into, text_udf(fields, setup)(F.col(text)))
