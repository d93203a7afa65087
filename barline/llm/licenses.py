"""License notices in texts: an exact containment join of text blocks with notice templates.

A block is a run of adjacent words of up to ``run`` times a template's words, within a line, or also across lines, as notices are
wrapped. It matches a template when it holds at least ``threshold`` of the template's
distinct words. Tokens are ordered by their frequency over all blocks, rarest first, so that

* prefix: a match must share one of the template's rarest ``n - need + 1`` tokens,
* length: a block of fewer than ``need`` distinct tokens cannot match,
* position: what is left after a shared token on either side bounds the overlap from above; in a run, words count only
  within reach of a token that the prefix filter asks for.

Tokens outside all templates never count towards an overlap; blocks are reduced to the others first.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from barline.llm.text import alnum_words, text_udf, utf8

# Notices by label. They are short and few; a run may pass its own.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "cc-by-4.0": "Licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "mit": "Released under the MIT License",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "public-domain": "This work is dedicated to the public domain",
}
# Phrases looked for word by word, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
THRESHOLD = 0.9
# Words of a run across lines, as a multiple of a template's; comment marks and a few stray words fit in.
RUN = 2.0
# Distinct tokens in all templates; they are sent to every task.
MAX_TOKENS = 100_000


class TemplateJoin:
    """The index of template prefixes, by the frequencies of tokens over all blocks."""

    def __init__(self, templates: Mapping[str, str], threshold: float, frequency: Mapping[bytes, int], run: float = RUN):
        self._runs = {label: int(run * len(alnum_words(notice))) for label, notice in templates.items()}
        sets = {label: set(alnum_words(notice)) for label, notice in templates.items()}
        self._rank = {t: i for i, t in enumerate(sorted(set().union(*sets.values()), key=lambda t: (frequency.get(t, 0), t)))}
        self._sets: dict[str, list[int]] = {}
        self._need: dict[str, int] = {}
        self._prefixes: dict[int, list[tuple[str, int]]] = defaultdict(list)
        for label, tokens in sets.items():
            if not tokens:
                continue
            ranks = self._sets[label] = sorted(self._rank[t] for t in tokens)
            need = self._need[label] = max(1, math.ceil(threshold * len(ranks) - 1e-9))
            for at, rank in enumerate(ranks[: len(ranks) - need + 1]):
                self._prefixes[rank].append((label, at))
        self._least = min(self._need.values(), default=0)

    def matches(self, block: list[bytes]) -> dict[str, float]:
        """Containment of each template that the block meets; none of those that it is too long for."""
        get = self._rank.get
        ranks = sorted({r for r in map(get, block) if r is not None})
        if not ranks or len(ranks) < self._least:
            return {}
        have, tried, found = set(ranks), set(), {}
        for at, rank in enumerate(ranks):
            for label, position in self._prefixes.get(rank, ()):
                need, template = self._need[label], self._sets[label]
                if label in tried or len(ranks) < need or len(block) > self._runs[label]:
                    continue
                tried.add(label)
                # The first shared token: before it the template's tokens are missing from the block.
                if 1 + min(len(template) - position - 1, len(ranks) - at - 1) < need:
                    continue
                overlap = sum(r in have for r in template)
                if overlap >= need:
                    found[label] = overlap / len(template)
        return found

    def run_matches(self, words: list[bytes]) -> dict[str, float]:
        """Best containment of each template in the runs of adjacent words that meet it."""
        ranked = [(at, r) for at, r in enumerate(map(self._rank.get, words)) if r is not None]
        have, found = {r for _, r in ranked}, {}
        # Where the tokens stand one of which a matching run must hold.
        marks: dict[str, list[int]] = defaultdict(list)
        for at, rank in ranked:
            for label, _ in self._prefixes.get(rank, ()):
                marks[label].append(at)
        for label, at_marks in marks.items():
            template, need, width = set(self._sets[label]), self._need[label], self._runs[label]
            if len(template & have) < need:
                continue

            def near(at: int) -> bool:
                mark = bisect_right(at_marks, at - width)
                return mark < len(at_marks) and at_marks[mark] < at + width

            inside = [(at, r) for at, r in ranked if r in template and near(at)]
            if len({r for _, r in inside}) < need:
                continue
            held: dict[int, int] = defaultdict(int)
            first = most = 0
            for at, rank in inside:
                held[rank] += 1
                while inside[first][0] <= at - width:
                    gone = inside[first][1]
                    held[gone] -= 1
                    if not held[gone]:
                        del held[gone]
                    first += 1
                most = max(most, len(held))
            if most >= need:
                found[label] = most / len(template)
        return found


def token_frequency(docs: DataFrame, templates: Mapping[str, str], text: str = "text") -> dict[bytes, int]:
    """Blocks of all texts that hold each template token; tokens are bounded by the templates."""
    tokens = sorted(set().union(*(alnum_words(notice) for notice in templates.values()), set()))
    if len(tokens) > MAX_TOKENS:
        raise ValueError(f"templates have {len(tokens)} tokens, more than {MAX_TOKENS}")
    at = {token: i for i, token in enumerate(tokens)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [0] * len(tokens)
        for batch in batches:
            for value in batch.column(0):
                for line in utf8(value.as_py()).split(b"\n"):
                    for token in at.keys() & alnum_words(line.decode()):
                        found[at[token]] += 1
        yield pa.RecordBatch.from_pydict({"token": list(range(len(tokens))), "blocks": found}, schema=_COUNTED)

    counted = docs.select(F.col(text)).mapInArrow(count, "token long, blocks long")
    return {tokens[r["token"]]: r["n"] for r in counted.groupBy("token").agg(F.sum("blocks").alias("n")).collect()}


_COUNTED = pa.schema([("token", pa.int64()), ("blocks", pa.int64())])


def phrase_places(words: list[bytes], phrases: Mapping[str, str]) -> list[tuple[int, str]]:
    """Start word and label of every place where a phrase's words stand in a row."""
    joined = b" " + b" ".join(words) + b" "
    out = []
    for phrase, label in phrases.items():
        sought = b" " + phrase.encode() + b" "
        at, counted, blanks = joined.find(sought), 0, 0
        while at >= 0:
            # Blanks are counted on from the last place.
            blanks += joined.count(b" ", counted, at)
            out.append((blanks, label))
            counted, at = at, joined.find(sought, at + 1)
    return out


def license_scan(
    docs: DataFrame,
    text: str = "text",
    into: str = "license",
    templates: Mapping[str, str] = TEMPLATES,
    phrases: Mapping[str, str] = PHRASES,
    threshold: float = THRESHOLD,
    run: float = 0.0,
) -> DataFrame:
    """``docs`` with a struct of word count, phrase places, labels and the best containment.

    One pass counts token frequencies over all texts, one joins; neither shuffles texts. ``score``
    is 1 where a phrase stands, else the best containment of a met template, else 0. Null and
    empty texts have no words and no labels. ``run`` lets blocks reach across lines, in runs of up to so many times a template's words;
    without it they stay within lines, and their reach is ``RUN``. Rows keep their other columns and their number; a column named as
    ``into`` is replaced.
    """
    frequency = token_frequency(docs, templates, text)
    vocabulary = set().union(*(alnum_words(notice) for notice in templates.values()), set())

    def setup() -> Callable[[str | None], tuple]:
        join = TemplateJoin(templates, threshold, frequency, run or RUN)

        def each(value: str | None) -> tuple:
            words = alnum_words(value)
            places = phrase_places(words, phrases)
            base = sorted({label for _, label in places})
            best: dict[str, float] = {}
            if not vocabulary.isdisjoint(words):
                found = [join.run_matches(words)] if run else []
                for line in value.split("\n"):
                    block = alnum_words(line)
                    found.append(join.matches(block))
                    if not run:
                        found.append(join.run_matches(block))
                for label, share in (match for matches in found for match in matches.items()):
                    best[label] = max(share, best.get(label, 0.0))
            starts = [start for start, _ in places]
            score = 1.0 if base else max(best.values(), default=0.0)
            return (
                len(words),
                len(places),
                min(starts, default=None),
                max(starts, default=None),
                ",".join(base),
                ",".join(sorted({*base, *best})),
                score,
            )

        return each

    fields = (
        "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    )
    return docs.withColumn(into, text_udf(fields, setup)(F.col(text)))
