"""Near duplicates, packing, language identification and the pipeline."""

from __future__ import annotations

import random
import re
import time
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from barline.llm import components, language, near_dedup, packing, vocabulary

from .conftest import ODD_TEXTS, prose

# Near duplicates


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(docs, percent):
    sets = {i: shingles(t) for i, t in docs}
    component = {i: i for i in sets}
    ids = sorted(sets)
    changed = True
    links = [
        (a, b)
        for a in ids
        for b in ids
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and sets[b]
    ]
    while changed:
        changed = False
        for a, b in links:
            low = min(component[a], component[b])
            changed |= component[a] != low or component[b] != low
            component[a] = component[b] = low
    return {i: (len(sets[i]), component[i]) for i in ids}


def edited(text, rng, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10_000)}"
    return " ".join(words)


def near_texts():
    rng = random.Random(2)
    out = [*ODD_TEXTS[:-1]]
    for g in range(12):
        base = prose(g, rng.choice([8, 30, 120, 300]), 4000)
        out += [base, base.upper()] + [edited(base, rng, rng.randint(0, 6)) for _ in range(rng.randint(0, 8))]
    chain = prose(50, 200, 4000)
    for _ in range(15):  # each near the one before, the ends far apart
        chain = edited(chain, rng, 2)
        out.append(chain)
    shared = prose(60, 150, 4000)
    out += [f"{shared} {prose(100 + i, 60, 4000)}" for i in range(25)]  # similar, not near
    return out


@pytest.mark.parametrize("similarity", [0.8, 0.85])
def test_near_duplicates(make_docs, similarity):
    texts = near_texts()
    rows = near_dedup.near_duplicates(make_docs(texts), similarity=similarity).collect()
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert found == brute_components(list(enumerate(texts)), round(100 * similarity))


def test_second_round_joins_components_in_blocks(make_docs, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    monkeypatch.setattr(near_dedup, "BROADCAST_IDS", 0)
    rng = random.Random(9)
    base = prose(1, 150, 4000)
    texts = [edited(base, rng, rng.randint(1, 5)) for _ in range(60)]
    rows = near_dedup.near_duplicates(make_docs(texts)).collect()
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert found == brute_components(list(enumerate(texts)), 80)


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(1)
    for share in (0.7, 0.8, 0.9, 0.97):
        common = rng.integers(0, 1 << 63, int(2000 * share), dtype=np.uint64)
        own = [rng.integers(0, 1 << 63, 2000 - len(common), dtype=np.uint64) for _ in range(2)]
        sets = [np.unique(np.concatenate([common, o])) for o in own]
        true = len(common) / (4000 - len(common))
        values = near_dedup.signatures(sets)
        assert (values[0] == values[1]).mean() == pytest.approx(true, abs=0.12)
        a, b = near_dedup.odd_sketches(values).view(np.uint64)
        differing = int(np.bitwise_count(a ^ b).sum())
        estimate = 1 + near_dedup.SKETCH_BITS / (4 * near_dedup.SAMPLES) * np.log(1 - 2 * differing / near_dedup.SKETCH_BITS)
        assert estimate == pytest.approx(true, abs=0.12)


@pytest.mark.parametrize("similarity", [0.8, 0.85])
def test_sketches_lose_no_more_than_bands(similarity):
    # By simulation: the loss of a lower limit is that of the exact distribution.
    rng = np.random.default_rng(4)
    differing = rng.binomial(near_dedup.SAMPLES, 1 - similarity, 20_000)
    odd = [np.bincount(rng.integers(0, near_dedup.SKETCH_BITS, 2 * d), minlength=near_dedup.SKETCH_BITS) % 2 for d in differing]
    bits = np.array([x.sum() for x in odd])
    for most in (60, 80, 90):
        assert (bits > most).mean() == pytest.approx(near_dedup._sketch_loss(similarity, most), abs=0.015)
    most = near_dedup._most_differing(similarity)
    bands = (1 - similarity**near_dedup.ROWS) ** near_dedup.BANDS
    assert near_dedup._sketch_loss(similarity, most) <= bands < near_dedup._sketch_loss(similarity, most - 2)


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(40)]
    edges += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(90)]
    found = {r["id"]: r["component"] for r in components.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    neighbours = defaultdict(set)
    for a, b in edges:
        if a != b:
            neighbours[a].add(b), neighbours[b].add(a)
    for start in neighbours:
        seen, queue = {start}, [start]
        while queue:
            for x in neighbours[queue.pop()] - seen:
                seen.add(x), queue.append(x)
        assert found[start] == min(seen)
    assert set(found) == set(neighbours)
    assert components.connected(spark.createDataFrame([], "a long, b long")).collect() == []


# Packing


def check_packing(rows, docs):
    ids = {i: packing.token_ids(t) for i, t in docs}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(ids)
    for i, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids[i])
            own = ids[i][at : at + r["length"]].tobytes()
            assert r["ids_crc32"] == zlib.crc32(own) and ("ids" not in r or bytes(r["ids"]) == own)
            at += r["length"]
        assert at == len(ids[i])
    lengths = []
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= packing.WINDOW and at & (at - 1) == 0  # no padding
        lengths.append(at)
    return lengths


def test_packing_round_trip(make_docs, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_TOKENS", 6_000)
    rng = random.Random(4)
    texts = [prose(rng.randrange(40), rng.randint(0, 700)) for _ in range(150)] + ODD_TEXTS
    rows = [r.asDict() for r in packing.pack(make_docs(texts), keep_ids=True).collect()]
    lengths = check_packing(rows, list(enumerate(texts)))
    assert sum(n == packing.WINDOW for n in lengths) > 0.8 * len(lengths)


def test_neighbours_are_ranked_by_bm25():
    rng = np.random.default_rng(3)
    rests = [packing.Rest(i, 0, 0, rng.integers(0, 50, rng.integers(5, 60)).astype("<u4")) for i in range(80)]
    held = np.array([sum(t in r.ids for r in rests) for t in range(50)])
    weight = np.log1p((80 - held + 0.5) / (held + 0.5))
    shard = packing.Shard(rests, weight)
    shard.unused[5] = False
    seed = rests[0]
    terms = sorted(set(seed.ids.tolist()))
    mean = np.mean([len(r.ids) for r in rests])

    def score(r):
        total = 0.0
        for t in terms:
            f = (r.ids == t).sum()
            total += weight[t] * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len(r.ids) / mean)) if f else 0.0
        return total

    shard.unused[0] = False
    want = sorted((i for i, r in enumerate(rests) if i not in (0, 5) and score(r) > 0), key=lambda i: -score(rests[i]))
    found = list(packing.ranked(shard.scores(seed), 7))
    assert sorted(found) == sorted(want)
    assert [round(score(rests[i]), 6) for i in found] == [round(score(rests[i]), 6) for i in want]


def test_ranked_keeps_ties_in_order():
    scores = np.array([0, 2.0, 5, 2, 0, 5, 2, 1] * 20)
    assert list(packing.ranked(scores, 3)) == sorted(np.flatnonzero(scores).tolist(), key=lambda i: (-scores[i], i))


def test_short_rests_of_one_topic_fill_a_window():
    """More neighbours than are tried one by one, all needed: a window of the seed's topic holds nothing else."""
    rng = np.random.default_rng(8)
    topics = [np.arange(10) + 10 * t + 1 for t in range(4)]
    rests = [packing.Rest(i, 0, 0, rng.choice(topics[i % 4], 6).astype("<u4")) for i in range(1000)]
    held = np.array([sum(t in r.ids for r in rests) for t in range(42)])
    shard = packing.Shard(rests, np.log1p((1000 - held + 0.5) / (held + 0.5)))
    first = next(packing.fill(shard, 1024))
    assert sum(len(r.ids) for r in first) == 1024 and len(first) > 150
    assert {r.doc % 4 for r in first} == {0}


def test_neighbours_share_windows(make_docs):
    rng = random.Random(1)
    # Topics with a vocabulary of their own, dealt out by turns.
    texts = [" ".join(f"{'xyzw'[i % 4]}{rng.randrange(30)}q" for _ in range(60)) for i in range(120)]
    by_sequence = defaultdict(list)
    for r in packing.pack(make_docs(texts)).collect():
        by_sequence[r["sequence_id"]].append(r["doc_id"] % 4)
    same = [max(map(s.count, set(s))) / len(s) for s in by_sequence.values() if len(s) > 2]
    assert sum(same) / len(same) > 0.75


def test_similar_rests_meet_across_shards_and_ranges(make_docs, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_TOKENS", 12_000)
    monkeypatch.setattr(packing, "RANGE_TOKENS", 40_000)
    rng = random.Random(5)
    # Twelve topics with a vocabulary of their own among words that all share, dealt out by turns over all ids.
    shared = [f"the{k}" for k in range(20)]
    words = [[f"{a}{b}{a}" for b in "bcdfghjklmnprstvz"] for a in "abcdefghijkl"]
    texts = [" ".join(rng.choice(words[i % 12] if rng.random() < 0.5 else shared) for _ in range(60)) for i in range(720)]
    by_sequence = defaultdict(list)
    for r in packing.pack(make_docs(texts)).collect():
        by_sequence[r["sequence_id"]].append(r["doc_id"])
    mates = [ids for ids in by_sequence.values() if len(ids) > 2]
    same = [max(map([i % 12 for i in ids].count, range(12))) / len(ids) for ids in mates]
    assert sum(same) / len(same) > 0.75
    assert sum(max(ids) - min(ids) > 240 for ids in mates) > 0.8 * len(mates)


def test_signature_leaves_the_closing_id_out():
    rng = np.random.default_rng(6)
    rests = [np.append(rng.integers(1, 5000, 200), packing.END) for _ in range(200)]
    held = np.bincount(np.concatenate([np.unique(r) for r in rests]), minlength=5000)
    weight = np.log1p((200 - held + 0.5) / (held + 0.5))
    race = packing._race(weight, held, packing.END)
    assert race[packing.END] == len(race)
    assert len({packing.signature(r, race)[0] for r in rests}) > 10


def test_signatures_are_the_first_distinct_places():
    rng = np.random.default_rng(9)
    # Short rests, with repeats and fewer distinct tokens than a signature has places.
    rests = [rng.integers(0, 12, n).astype("<u4") for n in rng.integers(1, 9, 300)]
    race = rng.permutation(12)
    race[[3, 7]] = 12  # tokens that come last
    want = [(sorted({int(race[t]) for t in r}) + [12] * packing.SIGNATURE)[: packing.SIGNATURE] for r in rests]
    assert [list(map(int, s)) for s in zip(*packing.signatures(rests, race))] == want
    batch = pa.RecordBatch.from_arrays([pa.array(range(300))] * 3 + [pa.array([r.tobytes() for r in rests])], names=[*"dst", "ids"])
    signed = pa.Table.from_batches(packing._sign(race)(iter([batch, batch.slice(0, 0), batch.slice(250)])))
    assert list(map(list, zip(*(c.to_pylist() for c in signed.columns[: packing.SIGNATURE])))) == want + want[250:]


def test_rests_are_counted_once_a_distinct_token():
    rests = [np.array(r, "<u4") for r in ([0], [1, 1, 2, 0], [2, 2, 2, 0], [1, 2, 1, 2, 0])]
    batch = pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in rests])], names=["ids"])
    (counted,) = packing._count(5)(iter([batch.slice(0, 3), batch.slice(3)]))
    assert counted.to_pydict() == {"token": [0, 1, 2], "documents": [4, 2, 3]}


def test_rows_of_a_trimmed_index_stay_in_one_piece():
    rests = [packing.Rest(i, 0, 6, np.array([1, 2, 3, 4 + i % 9, 13, 0], "<u4")) for i in range(100)]
    shard = packing.Shard(rests, np.append(0, np.ones(13)))
    shard.unused[::3] = False
    scores = shard.scores(rests[0])
    assert shard._rows.shape[1] == shard.unused.sum() and shard._rows.flags.c_contiguous
    assert ((scores > 0) == shard.unused).all()


def test_encoder_does_not_try_alternatives_one_by_one():
    """The pattern as the vocabulary states it cuts texts alike, but takes longer."""
    words = vocabulary.load(vocabulary.DEFAULT)
    stated = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    plain = tiktoken.Encoding("stated", pat_str=stated, mergeable_ranks=words.ids, special_tokens=words.special)
    ours = packing.encoder(vocabulary.DEFAULT)
    text = "It's the 12th house, and they'll see   more of\t it (with 300 words).\n" * 3_000

    def seconds(encoder):
        start = time.thread_time()
        encoder.encode_to_numpy(text)
        return time.thread_time() - start

    assert (ours.encode_to_numpy(text) == plain.encode_to_numpy(text)).all()
    runs = [(seconds(ours), seconds(plain)) for _ in range(15)]
    assert min(own for own, _ in runs) < 0.9 * min(other for _, other in runs)


# Language


def sentence(lang, rng):
    words = {
        "en": ["the", "house", "with", "thing", "which", "and", "though", "ring"],
        "de": ["der", "nicht", "schön", "über", "straße", "und", "zwischen", "ich"],
        "fr": ["le", "être", "où", "garçon", "beaucoup", "que", "très", "eau"],
    }[lang]
    return " ".join(rng.choice(words) + rng.choice(["", "", "s", "e"]) for _ in range(rng.randint(15, 90)))


def test_language_held_out(make_docs):
    rng = random.Random(1)
    texts = [(sentence(lang, rng), lang) for lang in ("en", "de", "fr") for _ in range(120)]
    network = language.train(texts[::2])
    held = texts[1::2] + [(None, "und"), ("", "und"), ("12 !? 3", "und")]
    rows = {r["doc_id"]: r["language"] for r in language.identify(make_docs([t for t, _ in held]), network).collect()}
    right = sum(rows[i]["lang"] == lang for i, (_, lang) in enumerate(held))
    assert right >= 0.97 * len(held) and [rows[i]["lang"] for i in range(len(held) - 3, len(held))] == ["und"] * 3
    assert all(0 <= r["score"] <= 1 for r in rows.values())


def test_letters_are_those_of_category_l(make_docs):
    texts = ["½", "²³", "①", "Ⅷ", "_ _", "5 ½", "ß", "ª", "日"]
    network = language.train([(sentence(lang, random.Random(i)), lang) for i in range(20) for lang in ("en", "de")], epochs=1)
    found = [r[0] for r in language.identify(make_docs(texts), network).orderBy("doc_id").select("language.lang").collect()]
    assert [f == language.UNKNOWN for f in found] == [True] * 6 + [False] * 3


def test_every_language_is_learned(make_docs, monkeypatch):
    langs = [f"l{i}" for i in range(230)]
    docs = make_docs([f"{lang} text {i}" for lang in langs for i in range(6)], langs=[lang for lang in langs for _ in range(6)])
    assert {lang for _, lang in language.training_sample(docs)} == set(langs)
    monkeypatch.setattr(language, "ALL_TRAINING_TEXTS", 460)
    some = language.training_sample(docs)
    assert 230 < len(some) < 700


def test_texts_of_a_language_not_learned_are_uncertain():
    rng = random.Random(5)
    examples = [(sentence(lang, rng), lang) for lang in ("en", "de") for _ in range(400)]
    network = language.train(examples)
    known = language.predict(network, [sentence(lang, rng) for lang in ("en", "de") for _ in range(100)])
    other = ["".join(rng.choice("αβγδεζηθικλμνξοπρστυφχψω ") for _ in range(n)) for n in (80, 400, 4000) for _ in range(20)]
    assert network.least_certain > 0.5
    assert sum(c >= network.least_certain for _, _, c in known) >= 195
    # Long texts are no more certain than short ones.
    assert sum(c < network.least_certain for _, _, c in language.predict(network, other)) >= 40


def plain_forward(network, row):
    """Log-probabilities of one window, filter by filter and place by place."""
    widest, pooled = max(language.WIDTHS), []
    for f in range(network.filters.shape[1]):
        responses = []
        for at in range(language.WINDOW - widest + 1):
            patch = np.concatenate([network.embedding[b] for b in row[at : at + widest]]).astype(np.float64)
            responses.append(patch @ network.filters[:, f].astype(np.float64) + network.bias[f])
        pooled.append(max(0.0, max(responses)))
    logits = np.array(pooled) @ network.output + network.offset
    return logits - np.log(np.exp(logits - logits.max()).sum()) - logits.max()


def test_prediction_equals_a_plain_forward_pass():
    rng = np.random.default_rng(9)
    network = language.ByteNetwork.fresh(["a", "b", "c"], rng)
    text = "".join(chr(97 + int(i)) for i in rng.integers(0, 26, 250))
    logs = np.array([plain_forward(network, row) for row in language.windows(text.encode())])
    damped = logs.sum(axis=0) / np.sqrt(len(logs))
    score = np.exp(damped - damped.max()) / np.exp(damped - damped.max()).sum()
    ((lang, best, certain),) = language.predict(network, [text])
    assert lang == "abc"[score.argmax()] and best == pytest.approx(score.max(), abs=1e-4)
    assert certain == pytest.approx(np.exp(logs.max(axis=1)).mean(), abs=1e-4)


def test_windows_cover_the_text():
    for n in (1, 95, 96, 97, 192, 500):
        data = bytes(random.Random(n).randrange(1, 256) for _ in range(n))
        rows = language.windows(data)
        assert rows.shape[1] == language.WINDOW
        whole = b"".join(r.tobytes() for r in rows)
        assert data[: n // 96 * 96] in whole and data[-min(n, 96) :] in whole


def test_gradients():
    rng = np.random.default_rng(2)
    network = language.ByteNetwork.fresh(["a", "b", "c"], rng)
    rows, labels = rng.integers(0, 256, (5, language.WINDOW)).astype(np.uint8), np.array([0, 1, 2, 0, 1])

    def loss():
        return -network.log_probabilities(rows)[np.arange(5), labels].astype(np.float64).mean()

    for weight, gradient in zip(network.weights(), network.gradients(rows, labels)):
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        before = weight[at]
        weight[at] = before + 1e-2
        up = loss()
        weight[at] = before - 1e-2
        down = loss()
        weight[at] = before
        assert (up - down) / 2e-2 == pytest.approx(gradient[at], rel=0.1, abs=2e-3)


def test_training_sample_is_bounded(make_docs):
    docs = make_docs([f"text {i}" for i in range(500)], langs=["en", "de"] * 250)
    some = language.training_sample(docs, F.col("doc_id") % 4 != 2, bound=50)
    assert 60 <= len(some) <= 150
    assert not any(int(t.split()[1]) % 4 == 2 for t, _ in some)


# Pipeline


def test_pipeline(spark, make_docs, tmp_path):
    """Stage by stage against plain Python on what the stage before kept."""
    rng = random.Random(7)
    leak, boiler = prose(900, 40, 5000), prose(901, 60, 5000)
    texts = [f"{prose(i, 60, 3000)}\n{boiler}" if i % 3 == 0 else prose(i, 80, 3000) for i in range(60)]
    texts += [texts[1]] * 12 + [edited(texts[4], rng, 1) for _ in range(5)] + [f"{prose(70, 50)} {leak}", "123 456", None]
    docs = make_docs(texts)
    folder = tmp_path / "tables"
    docs.write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame([(1, leak), (2, None)], "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, str(folder))
        docs = components.stored(docs, "stage")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    n = len(texts)
    assert kept["language_id"] == {i: t for i, t in enumerate(texts) if i < n - 2}
    lined = kept["line_dedup"]
    # The boilerplate stays in its first document; of 13 equal texts all but the first are repeated lines only.
    assert [i for i, t in lined.items() if boiler in t] == [0]
    assert set(lined) == set(kept["language_id"]) - set(range(60, 72))
    near = brute_components(list(lined.items()), 80)
    assert kept["near_dedup"] == {i: t for i, t in lined.items() if near[i][1] == i}
    assert kept["decontamination"] == {i: t for i, t in kept["near_dedup"].items() if leak not in t}
    assert any(leak in t for t in kept["near_dedup"].values())
    rows = [r.asDict() for r in corpus_pipeline.run(spark, str(folder)).collect()]
    check_packing(rows, list(kept["decontamination"].items()))


def test_registry_has_every_operator():
    import __spark_entry__ as registry

    names = registry.queries()
    assert {f"op{n}" for n in range(1, 11)} <= {name.split("_")[0] for name in names} and "pipeline" in names


def test_trimmed_index_gives_the_same_scores():
    rng = np.random.default_rng(5)
    weight = rng.random(50) + 0.1
    weight[0] = 0
    # Tokens below 5 are in most rests, the others in few.
    drawn = [np.concatenate([rng.integers(1, 5, 12), rng.integers(5, 50, 4), [0]]).astype("<u4") for _ in range(200)]
    rests = [packing.Rest(i, 0, 17, ids) for i, ids in enumerate(drawn)]
    shard, whole = packing.Shard(rests, weight), packing.Shard(rests, weight)
    whole._trim = lambda: None
    for used in range(0, 200, 10):
        assert (shard.scores(rests[used]) == whole.scores(rests[used])).all()
        shard.unused[used : used + 10] = whole.unused[used : used + 10] = False
    assert len(shard._rests) < 30 and shard._rows.shape[1] == len(shard._rests) and len(shard._owner) < len(whole._owner) / 5
    # No postings of the closing id, which tells nothing, nor of those that have rows.
    assert whole._rows.shape == (5, 200)
    assert len(whole._owner) == sum((np.unique(ids) >= 5).sum() for ids in drawn)
