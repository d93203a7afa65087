"""License scans, decontamination, secrets and line deduplication against brute force."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from barline.llm import decontamination, licenses, line_dedup, secrets
from barline.llm.text import alnum_words, ascii_lower

from .conftest import ODD_TEXTS, prose


def words_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


# Licenses


def license_texts():
    notices = list(licenses.TEMPLATES.values())
    out = [f"{prose(i, 20)}\n{n}\n{prose(i + 9, 9)}" for i, n in enumerate(notices)]
    out += [" ".join(random.Random(i).sample(n.split(), len(n.split()) - 1)) for i, n in enumerate(notices)]
    out += ["cc by cc by, CC-BY", "All rights  reserved. all RIGHTS reserved", "the general public license", "rights reserved"]
    rng = random.Random(4)
    tokens = sorted({t.decode() for n in notices for t in alnum_words(n)})
    return out + ["\n".join(" ".join(rng.sample(tokens, rng.randint(1, 25))) for _ in range(6)) for _ in range(60)]


def brute_licenses(text, threshold):
    labels, best = set(), 0.0
    for line in (text or "").split("\n"):
        block = words_of(line)
        for label, notice in licenses.TEMPLATES.items():
            template, width = set(words_of(notice)), int(licenses.RUN * len(words_of(notice)))
            share = max((len(template & set(block[i : i + width])) for i in range(len(block))), default=0) / len(template)
            if share >= threshold - 1e-9:
                labels.add(label)
                best = max(best, share)
    words = words_of(text)
    places = [
        (i, label)
        for phrase, label in licenses.PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    base = {label for _, label in places}
    starts = [i for i, _ in places]
    return (
        len(words),
        len(places),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(base | labels)),
        1.0 if base else best,
    )


@pytest.mark.parametrize("threshold", [0.5, licenses.THRESHOLD])
def test_licenses(make_docs, threshold):
    docs = make_docs([*ODD_TEXTS, *license_texts()])
    for row in licenses.license_scan(docs, threshold=threshold).collect():
        own = row["license"]
        names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
        assert tuple(own[n] for n in names) == pytest.approx(brute_licenses(row["text"], threshold)), row["text"]


def test_wrapped_notices(make_docs):
    texts = [
        "code\n * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided",
        "# This Source Code Form is subject to the terms of the Mozilla Public\n# License, v. 2.0. If a copy",
        f"Released under {prose(1, 30)}\nthe MIT {prose(2, 30)} License",  # the words, but far apart
    ]
    rows = {r["doc_id"]: r["license"] for r in licenses.license_scan(make_docs(texts), run=licenses.RUN).collect()}
    assert [rows[i]["labels"] for i in range(3)] == ["bsd", "mpl-2.0", ""]
    assert [rows[i]["score"] for i in range(3)] == [1.0, 1.0, 0.0]
    rng = random.Random(3)
    join = licenses.TemplateJoin(licenses.TEMPLATES, 0.6, {}, licenses.RUN)
    tokens = sorted({t for n in licenses.TEMPLATES.values() for t in alnum_words(n)}) + [b"other"] * 9
    for _ in range(40):
        words, want = [rng.choice(tokens) for _ in range(80)], {}
        for label, notice in licenses.TEMPLATES.items():
            template, width = set(alnum_words(notice)), int(licenses.RUN * len(alnum_words(notice)))
            share = max(len(template & set(words[i : i + width])) for i in range(len(words))) / len(template)
            want |= {label: share} if share >= 0.6 - 1e-9 else {}
        assert join.run_matches(words) == want


def test_words_scattered_over_a_long_line_are_no_notice(make_docs):
    rng = random.Random(2)
    words = [f"other{rng.randrange(900)}" for _ in range(5000)]
    for at, word in zip(range(100, 5000, 900), "released under the mit license".split()):
        words[at] = word
    texts = [" ".join(words), " ".join([*words[:2000], "Released under the MIT License", *words[2000:4000]])]
    for run in (0.0, licenses.RUN):
        rows = licenses.license_scan(make_docs(texts), run=run).orderBy("doc_id").collect()
        assert [r["license"]["labels"] for r in rows] == ["", "mit"]


def test_phrase_places_are_counted_in_linear_time():
    import time

    def seconds(n):
        start = time.process_time()
        assert licenses.phrase_places([b"cc", b"by"] * n, {"cc by": "cc-by"})[-1] == (2 * n - 2, "cc-by")
        return time.process_time() - start

    seconds(50_000)
    assert seconds(200_000) < 2.0


def test_token_frequency_counts_blocks(make_docs):
    counted = licenses.token_frequency(make_docs(["mit mit\nthe mit", "license", None]), licenses.TEMPLATES)
    assert counted[b"mit"] == 2 and counted[b"license"] == 1 and counted[b"gnu"] == 0


# Decontamination


def brute_hits(text, items, window):
    words, hit, names = words_of(text), set(), set()
    for item, body in items:
        own = words_of(body)
        size = min(window, len(own))
        patterns = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for at in range(len(words) - size + 1):
            if size and tuple(words[at : at + size]) in patterns:
                hit.update(range(at, at + size))
                names.add(item)
    return len(words), len(hit), sorted(names)


def test_blocks_are_passes_of_their_own(spark, make_docs):
    """However many blocks there are, the last stage has one Python node: earlier passes are stored."""
    items = [(i, prose(i, 20)) for i in range(30)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = make_docs([prose(i, 60) for i in range(20)] + [prose(3, 20)])
    found = decontamination.benchmark_hits(docs, benchmark, block_bytes=900)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "/hits-" in found.inputFiles()[0]
    assert [r["hits"]["items"] for r in found.orderBy("doc_id").collect()][-1] == ["3"]


@pytest.mark.parametrize("block_bytes", [decontamination.BLOCK_BYTES, 400])
def test_decontamination(spark, make_docs, block_bytes):
    rng = random.Random(3)
    alphabet = ["a", "b", "c", "É"]
    items = [(str(i), " ".join(rng.choice(alphabet) for _ in range(rng.randint(1, 16)))) for i in range(25)]
    items += [("25", "a-a, A!"), ("26", prose(1, 30)), ("27", prose(1, 30))]
    texts = [" ".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(40)]
    texts += [f"{prose(2, 30)} {prose(1, 30)}", "a a a", prose(1, 12), *ODD_TEXTS]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    found = decontamination.benchmark_hits(make_docs(texts), benchmark, block_bytes=block_bytes)
    found = found.withColumn("n_hit", decontamination.hit_words(F.col("hits")))
    for row in found.collect():
        want = brute_hits(row["text"], items, decontamination.WINDOW)
        assert (row["hits"]["n_words"], row["n_hit"], sorted(row["hits"]["items"])) == want, row["text"]


def test_search_skips_most_of_the_text():
    words = [f"x{i}".encode() for i in range(1000)]
    looked = []

    class Counting(dict):
        def get(self, key, default=None):
            looked.append(key)
            return default

    search = decontamination.WuManber({tuple(f"y{i}".encode() for i in range(10)): ["1"]}, 10)
    search._shift = Counting()
    assert list(search.search(words)) == [] and len(looked) < 1000 / 8


# Secrets


def brute_spans(text):
    out = []
    for rank, rule in enumerate(secrets.RULES):
        for m in re.finditer(rule.pattern, text or ""):
            if len(m.group(rule.group)) >= rule.least:
                out.append((m.start(), rank, m.end(), rule.kind))
    return sorted(out)


SECRETS = [
    'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" and PassWD:abcdef',
    "é👩 api_key=abc123 apikey: 'xyz789' API-KEY=abcdef",
    'secret=token"=abcdefgh secret: short token=token=abcdef',
    "AKIA" + "A1" * 8 + " AKIAAKIA" + "B" * 11 + " AKIASHORT",
    "0123456789abcdef" * 3 + " " + "f" * 23 + " " + "e" * 24,
    "ghp_" + "a1B2" * 9 + " xoxb-1234567890-abc eyJ" + "a" * 12 + "." + "b" * 12 + ".c",
    "-----BEGIN RSA PRIVATE KEY----- AIza" + "x" * 35,
    "password password= password=\n 'hunter22'",
]


def test_secrets(make_docs):
    rng = random.Random(5)
    pieces = ["token", "=", " ", '"', "secret", ":", "abcdef0", "AKIA", "ABCD1234", "é", "0f" * 13, "password"]
    texts = SECRETS + ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 60))) for _ in range(150)] + ODD_TEXTS
    rows = secrets.secret_spans(make_docs(texts)).withColumn("listed", secrets.listed(F.col("secrets"))).collect()
    for row in rows:
        want = brute_spans(row["text"])
        assert [tuple(s) for s in row["secrets"]] == want, row["text"]
        assert row["listed"] == ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in want)


def test_base_rules_equal_the_open_ended_patterns():
    """Bounded repeats in the rules find what open ones find and then drop for their length."""
    rng = random.Random(8)
    for pattern, least, rule in ((r"AKIA[A-Z0-9]+", 20, secrets.RULES[1]), (r"[0-9a-f]+", 24, secrets.RULES[2])):
        for _ in range(300):
            text = "".join(rng.choice(["AKIA", "B", "7", "ffff", "0123", " ", "x"]) for _ in range(30))
            open_ended = [m.span() for m in re.finditer(pattern, text) if len(m[0]) >= least]
            assert [m.span() for m in re.finditer(rule.pattern, text)] == open_ended


@pytest.mark.parametrize("rule", secrets.RULES, ids=lambda r: r.kind)
def test_matches_meet_their_trigram_query(rule):
    clauses = secrets.trigram_query(rule.pattern)
    assert (clauses is None) == (rule.kind == "hex")
    for text in SECRETS:
        for match in re.finditer(rule.pattern, text):
            lowered = match[0].lower()
            assert clauses is None or any(all(g in lowered for g in c) for c in clauses)


def test_queries_of_patterns():
    assert secrets.trigram_query("abcd") == [frozenset({"abc", "bcd"})]
    assert secrets.trigram_query("(abc|xyz)+") == [frozenset({"abc"}), frozenset({"xyz"})]
    assert secrets.trigram_query("ab?cd") == [frozenset({"abc", "bcd"}), frozenset({"acd"})]
    assert secrets.trigram_query("(abc)?[0-9]+") is None
    assert secrets.trigram_query("abc|[0-9]+") is None


# Lines


def brute_lines(docs, min_documents, keep_first):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\f\r"))

    holders, first = {}, {}
    for i, text in docs:
        for at, line in enumerate((text or "").split("\n")):
            holders.setdefault(key(line), set()).add(i)
            first[key(line)] = min(first.get(key(line), (i, at)), (i, at))
    out = {}
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [
            line
            for at, line in enumerate(lines)
            if not key(line) or len(holders[key(line)]) < min_documents or (keep_first and first[key(line)] == (i, at))
        ]
        out[i] = ("\n".join(kept), len(lines), len(lines) - len(kept))
    return out


@pytest.mark.parametrize("broadcast_bytes", [line_dedup.BROADCAST_BYTES, 0])
@pytest.mark.parametrize("keep_first", [False, True])
def test_lines(make_docs, monkeypatch, keep_first, broadcast_bytes):
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", broadcast_bytes)
    rng = random.Random(6)
    pool = ["Same line", " same LINE\t", "É line", "é line", "", "  ", "x", "\x1cx", "unique"]
    texts = ["\n".join(rng.choice([*pool, f"own {rng.random()}"]) for _ in range(rng.randint(1, 150))) for _ in range(40)]
    texts += [None, "", "same line"]
    docs = make_docs(texts)
    bitmaps = line_dedup.keep_bitmaps(docs, min_documents=10, keep_first=keep_first)
    want = brute_lines(list(enumerate(texts)), 10, keep_first)
    for row in line_dedup.apply_bitmaps(docs, bitmaps).collect():
        assert tuple(row["lines"]) == want[row["doc_id"]]
    assert sum(n for _, _, n in want.values()) > 100


def test_native_lower(spark):
    texts = ["ABC xyz", "ÄÖ ABC é", "İI ſ K", ""]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", ascii_lower(F.col("t")).alias("low")).collect()
    assert all(r["low"] == re.sub("[A-Z]", lambda m: m[0].lower(), r["t"]) for r in rows)


@pytest.mark.parametrize("operator", ["lines", "secrets"])
def test_native_plans_have_no_python(make_docs, operator):
    docs = make_docs(["x"]).select("doc_id", "text")
    if operator == "lines":
        out = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    else:
        out = secrets.secret_spans(docs)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


def test_many_secrets_of_one_text(make_docs):
    """Spans of more matches than are put together at once, in time that grows with their number."""
    n = 50_000
    texts = [" ".join(f"{i:032x}" for i in range(n)), " ".join(f"{i:032x}" for i in range(700))]
    import time

    start = time.perf_counter()
    rows = {r["doc_id"]: r["secrets"] for r in secrets.secret_spans(make_docs(texts)).collect()}
    assert time.perf_counter() - start < 60
    for doc, number in ((0, n), (1, 700)):
        hexes = [(s["start"], s["end"]) for s in rows[doc] if s["kind"] == "hex"]
        assert hexes == [(33 * i, 33 * i + 32) for i in range(number)]


def test_texts_are_not_shuffled_to_meet_their_candidates(make_docs, spark, tmp_path, monkeypatch):
    texts = [f"password: hunter{i}22 AKIA{'ABCD' * 4} {'ab12' * 8}" for i in range(30)] + [prose(i, 30) for i in range(30)]
    make_docs(texts).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    near = secrets.secret_spans(docs)
    assert "Exchange hashpartitioning" not in near._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(secrets, "MAX_BROADCAST", 0)
    far = secrets.secret_spans(docs)
    assert sorted(map(str, near.collect())) == sorted(map(str, far.collect()))
