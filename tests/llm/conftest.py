from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

from barline.llm.queries import share_package

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(autouse=True)
def shared(spark):
    share_package(spark)


@pytest.fixture
def make_docs(spark):
    """Documents of the given texts, numbered from 0, or of (doc_id, text) pairs."""

    def make(texts, langs=None):
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        langs = langs or ["en"] * len(pairs)
        rows = [(i, t, lang, "s", len(t or "")) for (i, t), lang in zip(pairs, langs)]
        return spark.createDataFrame(rows, DOCUMENTS)

    return make


LONG = " ".join(f"word{i % 977}" for i in range(40_000))
# Null and empty texts, blanks, ties, a very long text, and code points of every width.
ODD_TEXTS = [
    None,
    "",
    " \n\t\n",
    "one",
    "one",
    "Größe çé 日本語 👩‍👩‍👧",
    "\x1c\x85\xa0 a",
    "a\r\nb\n\na",
    LONG,
]


@pytest.fixture
def odd_docs(make_docs):
    """Odd texts, a repeated row, a key that repeats with another text and a null key; clashing extra columns."""
    from pyspark.sql import functions as F

    docs = make_docs([*enumerate(ODD_TEXTS), (3, "one"), (4, "two words"), (None, "one"), (None, None)])
    clashing = "id n hash salt doc pos line lines bucket component first keep text_hash set_key tokens score kept size a b part ids"
    return docs.withColumns({name: F.lit(name) for name in clashing.split()})


@pytest.fixture
def empty_docs(make_docs):
    return make_docs([])


def prose(seed: int, n: int, words: int = 400) -> str:
    """Made-up text of ``n`` words from a vocabulary of its own."""
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))
