from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from barline.llm import packing, vocabulary
from barline.llm.token_counts import PrefixCounter, PrefixCounts, longest_within, token_counts

LIBRARY = Tokenizer.from_file(vocabulary.DEFAULT)
COUNTER = PrefixCounter()


def encoded(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


CASES = [
    "",
    " ",
    "   foo",
    "foo  \n bar's",
    "don't we're they'll 've I'd",
    "'rex 'r 'll !'re ''s",
    "foo<|endoftext|>bar  <|endoftext|>",
    "<|endoftext|",
    "\n\n\n  x\t\ty",
    "Größe çé 日本語テスト 👩‍👩‍👧 é",
    "a" * 70,
    "\x85\xa0 a b\x1cc 1234567 3.14",
    "՘a ՙb",
]


@pytest.mark.parametrize("text", CASES)
def test_every_prefix(text):
    counts = np.cumsum(COUNTER.deltas(text))
    assert [int(c) for c in counts] == [len(encoded(text[:i])) for i in range(1, len(text) + 1)]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab 'slrev\n\tdém!0 1日 ́x<|> ", max_size=30))
def test_every_prefix_of_random_texts(text):
    counts = np.cumsum(COUNTER.deltas(text))
    assert [int(c) for c in counts] == [len(encoded(text[:i])) for i in range(1, len(text) + 1)]


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60))
def test_packing_encoder_equals_the_library(text):
    assert packing.token_ids(text).tolist() == [*encoded(text), packing.END]


def test_operator_stores_counts(make_docs):
    texts = [None, "", *CASES, "some words of an ordinary text, " * 40]
    for row in token_counts(make_docs(texts), 7).collect():
        text, stored = row["text"] or "", PrefixCounts(row["tokens"]["prefixes"])
        assert row["tokens"]["n_tokens"] == stored.tokens() == len(encoded(text))
        best = max(i for i in range(len(text) + 1) if len(encoded(text[:i])) <= 7)
        assert row["tokens"]["fitting_chars"] == stored.characters_within(7) == best
        assert stored.tokens(min(3, len(text))) == len(encoded(text[:3]))


def test_counts_may_fall():
    assert longest_within(np.array([1, 2, 3, 2, 4]), 2) == 4
    assert longest_within(np.array([3]), 2) == 0


def test_vocabularies_that_split_otherwise_are_refused():
    import public_tokenizers

    from barline.llm import vocabulary

    with pytest.raises(ValueError):
        vocabulary.load(public_tokenizers.path("word_bpe_49k.json"))
