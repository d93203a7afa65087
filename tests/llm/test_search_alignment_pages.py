"""Ranked search, token alignment and page text: brute force, odd rows, and many small units of work."""

from __future__ import annotations

import hashlib
import html
import math
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barline.llm import html_text, lexical_search, queries, token_alignment

from .conftest import ODD_TEXTS, prose

SF_DIR = "/root/testdata/sf0.001"

# Ranked search


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_ranking(docs, items, best):
    """(item, rank, doc, score) rows, sorted; ``docs`` are (id, text) rows."""
    held = [(d, Counter(terms(t))) for d, t in docs if d is not None and terms(t)]
    n_all, total = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in set(items):
        scores = []
        for doc, counts in held:
            m = 100 - 50 + (50 * counts.total() * n_all) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1)))
                * ((1000000000 * counts[t]) // (1000 * counts[t] + 20 * m))
                for t in set(terms(text))
                if t in counts
            )
            if score > 0:
                scores.append((-score, doc))
        out += [(item, rank, doc, -score) for rank, (score, doc) in enumerate(sorted(scores)[:best], 1)]
    return sorted(out, key=str)


def ranking(docs, items, **settings):
    return sorted((tuple(r) for r in lexical_search.ranked_search(docs, items, **settings).collect()), key=str)


@pytest.mark.parametrize("seed", range(200))
def test_nra_finds_all_members_and_ties(seed, monkeypatch):
    rng = np.random.default_rng(seed)
    monkeypatch.setattr(lexical_search, "FIRST_READ", int(rng.integers(1, 40)))
    size, best, total, lists = int(rng.integers(1, 300)), int(rng.integers(1, 20)), Counter(), []
    for _ in range(rng.integers(1, 9)):
        docs = rng.permutation(size)[: rng.integers(0, size + 1)]
        impact = np.sort(rng.integers(1, rng.choice([3, 50, 10_000]), len(docs)))[::-1]
        lists.append((docs, impact))
        total.update(dict(zip(docs.tolist(), impact.tolist())))
    floor = int(rng.choice([1, 5, 100, 20_000]))
    ordered = sorted(total.values(), reverse=True)
    limit = max(floor, ordered[best - 1] if len(ordered) >= best else 1)
    found, scores = lexical_search.nra(lists, size, best, floor)
    assert dict(zip(found.tolist(), scores.tolist())) == {d: s for d, s in total.items() if s >= limit}


def test_nra_leaves_most_of_long_lists_unread():
    n = 200_000
    order = np.random.default_rng(3).permutation(n)
    impact = np.sort(np.random.default_rng(4).zipf(1.6, n).clip(1, 10**9))[::-1].copy()
    read = []

    class Seen(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, slice):
                read.append(at.stop)
            return super().__getitem__(at)

    found, _ = lexical_search.nra([(order.view(Seen), impact)], n, 10)
    assert set(order[:10].tolist()) <= set(found.tolist()) and max(read) < n / 50


def test_search_matches_brute_force_in_small_shards_and_blocks(make_docs, spark, monkeypatch):
    docs = [(i, prose(i % 37, 5 + i % 60, words=60)) for i in range(300)]
    items = [(i, prose(1000 + i, 8, words=70)) for i in range(25)]
    frame = spark.createDataFrame(items, "item_id long, text string")
    expected = brute_ranking(docs, items, 20)
    assert ranking(make_docs(docs).repartition(6), frame, best=20) == expected
    monkeypatch.setattr(lexical_search, "SHARD_POSTINGS", 200)
    monkeypatch.setattr(lexical_search, "FIRST_READ", 3)
    assert ranking(make_docs(docs).repartition(3), frame, best=20) == expected
    # Small blocks: every block is a pass of its own.
    assert ranking(make_docs(docs).repartition(3), frame, best=20, block_queries=4) == expected


def test_search_of_odd_rows(odd_docs, empty_docs, spark):
    items = [(1, "one WORD1 ünused"), (1, "one WORD1 ünused"), (1, "größe Größe"), (None, "two b"), (2, None), (3, ""), (4, "...")]
    frame = spark.createDataFrame(items, "item_id long, text string").withColumns(
        {name: F.lit("x") for name in ("number", "rank", "score", "doc_id", "query", "salt")}
    )
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert ranking(odd_docs, frame) == brute_ranking(docs, items, 50)
    assert ranking(empty_docs, frame) == [] and ranking(odd_docs, frame.limit(0)) == []


def test_search_ranks_ties_by_id(make_docs, spark):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    docs = make_docs([(i, "a b c") for i in range(200, 0, -1)] + [(0, "c")]).repartition(7)
    rows = ranking(docs, items, best=50)
    assert sorted((r[1], r[2]) for r in rows) == [(i, i) for i in range(1, 51)] and len({r[3] for r in rows}) == 1


# Token alignment

_FIRST = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
_FIRST.encode_special_tokens = True
_SECOND = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {chr(b): b for b in _PRINTABLE} | {
    chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)
}


def sides(text):
    """(ids, byte ends) of both sides by the libraries; empty if either does not give the text back."""
    if not text:
        return ([], []), ([], [])
    a = _FIRST.encode(f" {text}", add_special_tokens=False).ids
    b = _SECOND.encode(text)
    spelled_a = [bytes(_BYTES[c] for c in _FIRST.id_to_token(i)) for i in a]
    pieces = [_SECOND.id_to_piece(i) for i in b]
    spelled_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]
    if not b"".join(spelled_a) == b"".join(spelled_b) == f" {text}".encode():
        return ([], []), ([], [])
    return (a, np.cumsum([len(s) for s in spelled_a]).tolist()), (b, np.cumsum([len(s) for s in spelled_b]).tolist())


def brute_alignment(texts):
    grouped = []
    for text in texts:
        (a, ends_a), (b, ends_b) = sides(text)
        groups, at_a, at_b = [], 0, 0
        place_a, place_b = ({end: i + 1 for i, end in enumerate(ends)} for ends in (ends_a, ends_b))
        for end in sorted(set(ends_a) & set(ends_b)):
            to_a, to_b = place_a[end], place_b[end]
            groups.append((a[at_a:to_a], b[at_b:to_b]))
            at_a, at_b = to_a, to_b
        grouped.append((len(a), len(b), groups))
    links = [Counter((x, y) for ga, gb in groups for x in ga for y in gb) for _, _, groups in grouped]
    count = Counter(p for c in links for p in c)
    highest = defaultdict(int)
    for (x, _), n in count.items():
        highest[x] = max(highest[x], n)
    out = []
    for (n_a, n_b, groups), c in zip(grouped, links):
        text = ";".join(f"{','.join(map(str, ga))}|{','.join(map(str, gb))}" for ga, gb in groups)
        best = sum(n for (x, y), n in c.items() if count[x, y] == highest[x])
        total = sum(n * count[p] for p, n in c.items())
        out.append((n_a, n_b, len(groups), c.total(), best, total, hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


def aligned(docs):
    return sorted((tuple(r) for r in token_alignment.align(docs).collect()), key=str)


MIXED = [
    "<|endoftext|> and <s> </s> <unk> <0x41> are plain text here",
    "two  spaces   and\ttabs\n\nand\x00nul, \r\n \x85\xa0 ends ",
    " leading and trailing ",
    "▁ does not come back",
    "日本語のテキスト、漢字とかな。한국어 العربية हिन्दी 👩‍👩‍👧 ééé",
    "thonanerre ononenin 1234567 3.14159 don't I'll www.example.com/a?b=c&d=e",
    "=" * 300 + "a" * 200 + " " * 50 + "x",
]


def test_alignment_matches_brute_force(make_docs, monkeypatch):
    texts = [*MIXED, *(prose(i, 40) for i in range(30)), *MIXED[:3]]
    expected = sorted(((i, *row) for i, row in enumerate(brute_alignment(texts))), key=str)
    assert aligned(make_docs(texts).repartition(3)) == expected
    # Chunks of two documents, and merges of two runs: several waves.
    monkeypatch.setattr(token_alignment, "CHUNK_DOCUMENTS", 2)
    monkeypatch.setattr(token_alignment, "FAN_IN", 4)
    monkeypatch.setattr(token_alignment, "_LARGE", 4)
    assert aligned(make_docs(texts).repartition(3)) == expected


def test_alignment_of_odd_rows(odd_docs, empty_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    expected = sorted(((d, *row) for (d, _), row in zip(rows, brute_alignment([t for _, t in rows]))), key=str)
    assert aligned(odd_docs) == expected
    assert aligned(empty_docs) == []


def test_alignment_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    expected = sorted(((d, *row) for (d, _), row in zip(docs, brute_alignment([t for _, t in docs]))), key=str)
    assert sorted((tuple(r) for r in queries.op12_token_alignment(spark, SF_DIR).collect()), key=str) == expected


def test_merges_sum_and_give_back():
    rng = np.random.default_rng(5)
    made, total = [], Counter()
    for _ in range(7):
        own = {(int(a) << 32 | int(b)): int(n) for a, b, n in rng.integers(1, 9, (rng.integers(0, 30), 3))}
        total.update(own)
        pairs = np.array(sorted(own), np.int64)
        made.append((pairs, token_alignment.run_of(pairs, np.array([own[int(p)] for p in pairs], np.int64))))
    table = pa.table({"radix": [3] * 7, "run": list(range(7)), "entries": [r for _, r in made]})
    back = token_alignment._count((pa.scalar(3, pa.int32()),), table)
    highest = {a: max(n for p, n in total.items() if p >> 32 == a) for a in {p >> 32 for p in total}}
    for (pairs, _), frame in zip(made, back["counted"].to_pylist()):
        counts, best = token_alignment.unpacked(frame)
        assert counts.tolist() == [total[p] for p in pairs.tolist()]
        assert best.tolist() == [total[p] == highest[p >> 32] for p in pairs.tolist()]


# Page text


def test_query_gives_the_article_of_every_page(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()
    rows = {r["page_id"]: r for r in queries.op13_html_text(spark, SF_DIR).collect()}
    assert len(rows) == len(pages)
    for page in pages:
        article = re.search("<article>(.*?)</article>", page["html"], re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", p)).split()) for p in re.split("</?(?:p|h1)>", article)]
        text = "\n\n".join(p for p in parts if p)
        assert (rows[page["page_id"]]["text"], rows[page["page_id"]]["n_chars"]) == (text, len(text))


LONG = "This paragraph has as many words as paragraphs of articles have. " * 5
CHROME = '<div id="top"><a href=/>Home</a> <a href=/x>About us</a></div><div class="cookie-notice"><p>We use cookies.</p></div>'
BODY = f"<h1>A title</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p>"
WANTED = ["A title", LONG.strip(), "Short.", LONG.strip()]


@pytest.mark.parametrize(
    "page",
    [
        f"<html><body>{CHROME}<article>{BODY}</article><footer>f</footer></body></html>",
        f"{CHROME}<header><h1>Site</h1></header><main><header><p>by A</p></header>{BODY}</main><aside><p>{LONG}</p></aside>",
        f'{CHROME}<div id="page"><div class="sidebar"><p>{LONG}</p></div><div id="content">{BODY}'
        f'<section id="comments"><p>{LONG}</p></section></div></div><div class="site-footer">c</div>',
        f'<body class="has-sidebar"><div class="content with-sidebar">{BODY}</div><form><p>Sign</p></form></body>',
        f'<article>{BODY}<div class="ad">Buy</div><p hidden>x</p><script>var a="<p>b</p>"</script><style>p{{}}</style></article>',
        f"<article><h1>A title<p><b>{LONG}<br><p>Short.<p>{LONG}<!-- no --></article><div class=related><p>{LONG}</p></div>",
    ],
)
def test_layouts(page):
    assert html_text.blocks(page) == WANTED


def test_a_body_of_paragraphs_outweighs_the_name_of_its_element():
    assert html_text.blocks(f'<div class="widget">{BODY}<p>{LONG}</p></div>') == [*WANTED, LONG.strip()]


def test_blocks_are_decoded_and_spaced():
    page = "<article><p>Fish &amp; chips&nbsp;&#8212;\n caf&eacute; &ltx&gt; <b>bo</b>ld<br>line <span style='display:none'>no</span></p><ul><li>one<li>two</ul></article>"
    assert html_text.blocks(page) == ["Fish & chips — café <x> bold line", "one", "two"]
    assert html_text.blocks("<article><p>See <a class='related' href=/x>this</a> too</p></article>") == ["See this too"]
    assert html_text.blocks("<nav>a</nav><div class='ad'>buy</div><footer>x</footer>") == []
    assert html_text.blocks("just text") == ["just text"]


@pytest.mark.parametrize("part", ["<div>", "<p>a <b>b ", "<li>x<div>", "<a ", "<!--", "</a ", "<![x", "<p><![foo[x]]>y", "<x y=\"", "<", "&am"])
def test_broken_markup_takes_linear_time(part):
    import time

    start = time.process_time()
    html_text.blocks(part * 40_000)
    assert time.process_time() - start < 10


def test_smoothing_keeps_level_lines_level():
    assert np.allclose(html_text.smoothed(np.full(9, 3.0)), 3.0)
    assert html_text.smoothed(np.array([0.0, 9.0, 0.0])).argmax() == 1


def test_pages_with_odd_rows(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "<p>x</p>"), (3, "\x00<p>\x1c a</p>"), (4, f"<article>{'<p>word</p>' * 50_000}</article>")]
    pages = spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit("own")).withColumn("n_chars", F.lit(7))
    out = html_text.main_text(pages).collect()
    assert len(out) == len(rows) and {r["text"] for r in out} == {"own"}
    assert [r["content"]["text"] for r in out[:4]] == ["", "", "", "x"]
    assert out[5]["content"]["n_chars"] == 50_000 * 6 - 2
    assert html_text.main_text(pages.limit(0)).collect() == []
    # A column of the name asked for is replaced.
    assert [r["text"] for r in html_text.main_text(pages, into="text").collect()] == [r["content"] for r in out]
