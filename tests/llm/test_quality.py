from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from barline.llm import quality as q

from .conftest import ODD_TEXTS, prose


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    number = Counter(runs)
    inside = {j for i, r in enumerate(runs) if number[r] > 1 for j in range(i, i + 5)}
    lines, seen, repeated = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, repeated, len(inside), failed


def random_text(seed):
    rng = random.Random(seed)
    return "".join(rng.choice([" a", " b", " c", "\n", "\t", "#", " é", "\x1c", "\xa0", "|"]) for _ in range(rng.randint(0, 120)))


def test_base_counts_equal_brute_force(make_docs):
    texts = [*ODD_TEXTS, *(random_text(s) for s in range(80)), prose(1, 30), prose(1, 30) * 2]
    for row in q.quality(make_docs(texts)).collect():
        own = row["quality"]
        got = tuple(own[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
        assert got == brute(row["text"]), row["text"]
        assert not (own["base_failed"] and own["kept"])


def test_distance():
    p = np.array([0.5, 0.5, 0.0])
    assert q.jensen_shannon(p, p) == 0
    assert q.jensen_shannon(np.array([1.0, 0.0]), np.array([0.0, 1.0])) == pytest.approx(1.0)
    m = np.array([0.25, 0.5, 0.25])
    by_hand = np.sqrt(0.5 * (0.5 * np.log2(2)) + 0.5 * (0.5 * np.log2(2)))
    assert q.jensen_shannon(p, np.array([0.0, 0.5, 0.5])) == pytest.approx(by_hand)
    assert 0 < q.jensen_shannon(p, m) < 1


def test_clean_texts_stay_and_junk_goes(make_docs):
    def text(i):
        rng = random.Random(i)
        return " ".join(rng.choice(["house", "tree", "and", "the", "of", f"{rng.choice('abcdefgh')}ord"]) for _ in range(200))

    # The lines keep repeated windows rare; the junk has the same words among symbols or in capitals.
    clean = [" ".join(f"{w}{chr(97 + i % 26)}" for i, w in enumerate(text(k).split())) for k in range(60)]
    junk = [" ".join(w + "#$%&" * 3 for w in clean[0].split()), clean[1].upper() + "!!"]
    rows = {r["doc_id"]: r["quality"] for r in q.quality(make_docs(clean + junk)).collect()}
    assert all(rows[i]["kept"] for i in range(60))
    assert not rows[60]["kept"] and not rows[61]["kept"] and rows[60]["class_distance"] > q.MAX_CLASS_DISTANCE


def test_short_texts_are_not_judged_by_histograms(make_docs):
    rows = q.quality(make_docs(["a b c d e f g h i j", *[prose(i, 100) for i in range(5)]])).collect()
    short = next(r["quality"] for r in rows if r["doc_id"] == 0)
    assert short["word_distance"] is None and short["class_distance"] is None and short["kept"]


def test_references_count_everything(spark, make_docs):
    known = q.references(make_docs(["aa b", "aa C", "de", None], langs=["x", "x", "y", "y"]))
    assert set(known.classes) == {"x", "y"}
    assert known.words["x"] == {b"aa": 0.5, b"b": 0.25, b"c": 0.25}
    assert known.classes["x"][q.CLASSES.index("upper")] == pytest.approx(1 / 8)


def test_unknown_words_of_ordinary_characters_go(make_docs):
    rng = random.Random(7)

    def word():
        return "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8)))

    def clean(n):  # four of ten words are common ones
        return " ".join(rng.choice(["the", "of", "and", "to", "in", "that"]) if rng.random() < 0.4 else word() for _ in range(n))

    texts = [clean(rng.randint(60, 400)) for _ in range(60)]
    junk = [" ".join(word() for _ in range(n)) for n in (60, 150, 300)]
    rows = {r["doc_id"]: r["quality"] for r in q.quality(make_docs(texts + junk)).collect()}
    assert all(rows[i]["kept"] for i in range(60))
    assert all(rows[i]["class_distance"] < q.MAX_CLASS_DISTANCE and not rows[i]["kept"] for i in (60, 61, 62))


def test_every_language_of_enough_documents_is_a_reference(make_docs):
    rng = random.Random(8)

    def text(letters, common):
        return " ".join(rng.choice(common) if rng.random() < 0.4 else "".join(rng.choices(letters, k=5)) for _ in range(120))

    latin, cyrillic, greek = "etaoinshr", "абвгдежзик", "αβγδεζηθικ"
    texts = [(text(latin, ["the", "of", "and"]), "en") for _ in range(2100)]
    texts += [(text(cyrillic, ["и", "не", "на"]), "ru") for _ in range(q.LEAST_DOCUMENTS)]  # less than 1 % of all
    texts += [(text(greek, ["και", "το"]), "el") for _ in range(3)]
    rows = [r.asDict(True) for r in q.quality(make_docs(*zip(*texts))).collect()]
    assert all(r["quality"]["kept"] for r in rows)
    by = {lang: [r["quality"]["class_distance"] for r in rows if r["lang"] == lang] for lang in ("ru", "el")}
    assert max(by["ru"]) < q.MAX_CLASS_DISTANCE and by["el"] == [None] * 3


def test_many_even_languages_are_references(make_docs):
    texts = [prose(i, 60, 30) for i in range(120)] * q.LEAST_DOCUMENTS
    known = q.references(make_docs(texts, [f"l{i % 120}" for i in range(len(texts))]), least=q.LEAST_DOCUMENTS)
    assert len(known.classes) == len(known.words) == 120


def test_indexed_distances_equal_dense_ones():
    rng = random.Random(9)
    words = {n: {b"w%d" % rng.randrange(60): rng.random() / 40 for _ in range(30)} for n in "abc"} | {"d": {b"x": 1.0}}
    index = q.WordIndex(words)
    for _ in range(20):
        counts = Counter(b"w%d" % rng.randrange(90) for _ in range(rng.randint(1, 200)))
        n = sum(counts.values())
        for got, common in zip(index.distances(counts, n), words.values()):
            own = np.array([counts[w] for w in common]) / n
            reference = np.array([*common.values(), max(0.0, 1 - sum(common.values()))])
            assert got == pytest.approx(q.jensen_shannon(np.append(own, 1 - own.sum()), reference), abs=1e-7)
