"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

from __future__ import annotations

import pytest

import corpus_pipeline
from barline.llm import (
    decontamination,
    language,
    licenses,
    line_dedup,
    near_dedup,
    packing,
    quality,
    secrets,
    token_counts,
    toxicity,
)

BENCHMARK = [(1, "one"), (1, "one"), (None, "one"), (2, None), (3, ""), (4, "word1 word2 word3")]


@pytest.fixture
def benchmark_items(spark):
    return spark.createDataFrame(BENCHMARK, "item_id long, text string")


def by_row(name, items=None):
    """Operators that add a struct to each row."""
    network = language.train([("the house is old", "en"), ("das haus ist alt", "de")], epochs=1)
    return {
        "toxicity": lambda d: toxicity.toxicity(d, toxicity.fit([("bad", 1), ("good", 0)])),
        "quality": quality.quality,
        "licenses": licenses.license_scan,
        "tokens": lambda d: token_counts.token_counts(d, 10),
        "language": lambda d: language.identify(d, network),
        "decontamination": lambda d: decontamination.benchmark_hits(d, items),
        "secrets": secrets.secret_spans,
        "lines": lambda d: line_dedup.apply_bitmaps(d, line_dedup.keep_bitmaps(d, min_documents=2)),
    }[name]


NAMES = ["toxicity", "quality", "licenses", "tokens", "language", "decontamination", "secrets", "lines"]
ADDED = {
    "toxicity": "toxicity",
    "quality": "quality",
    "licenses": "license",
    "tokens": "tokens",
    "language": "language",
    "decontamination": "hits",
    "secrets": "secrets",
    "lines": "lines",
}


@pytest.mark.parametrize("name", NAMES)
def test_rows_are_kept_and_equal_texts_get_equal_results(name, odd_docs, benchmark_items):
    out = by_row(name, benchmark_items)(odd_docs).collect()
    assert len(out) == odd_docs.count()
    assert set(odd_docs.columns) <= set(out[0].asDict())
    found = {}
    for row in out:
        if name != "lines":  # whose result depends on the document as well
            assert found.setdefault(row["text"] or "" if name != "language" else row["text"], row[ADDED[name]]) == row[ADDED[name]]
        assert row[ADDED[name]] is not None


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(name, empty_docs, benchmark_items):
    assert by_row(name, benchmark_items)(empty_docs).collect() == []


def test_near_duplicates(odd_docs, empty_docs):
    rows = {r["doc_id"]: r for r in near_dedup.near_duplicates(odd_docs).collect()}
    assert len(rows) == odd_docs.select("doc_id").distinct().count()
    assert rows[0]["n_shingles"] == rows[1]["n_shingles"] == rows[2]["n_shingles"] == 0
    assert [rows[i]["component_id"] for i in (0, 1, 2, 3)] == [0, 1, 2, 3]
    # Document 4 has two texts: one of them counts. A null key has no component.
    assert rows[4]["component_id"] in (3, 4) and rows[None]["component_id"] is None
    assert near_dedup.near_duplicates(empty_docs).collect() == []


def test_packing(odd_docs, empty_docs):
    rows = packing.pack(odd_docs).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 3) == 2 * len(packing.token_ids("one"))
    assert sum(r["length"] for r in rows if r["doc_id"] == 0) == 1
    assert packing.pack(empty_docs).collect() == []


def test_null_id_lines(make_docs):
    docs = make_docs([(None, "x\ny"), (1, "x"), (2, "x\nz")])
    done = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs, min_documents=3))
    assert {r["doc_id"]: r["lines"]["kept"] for r in done.collect()} == {None: "y", 1: "", 2: "z"}


def test_no_training_rows(spark, odd_docs, empty_docs):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(toxicity.training_sample(odd_docs, labels))
    assert all(0 <= r["toxicity"]["score"] < 0.5 for r in toxicity.toxicity(odd_docs, model).collect())
    network = language.train(language.training_sample(empty_docs))
    assert {r["language"]["lang"] for r in language.identify(odd_docs, network).collect()} == {language.UNKNOWN}


def test_pipeline_stages(spark, odd_docs, tmp_path):
    spark.createDataFrame(BENCHMARK, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for docs in (odd_docs, odd_docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns and out.schema["text"].dataType == docs.schema["text"].dataType
            assert out.count() <= docs.count()
        corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count()


@pytest.mark.parametrize("name", NAMES)
def test_a_column_of_the_name_asked_for_is_replaced(name, make_docs, benchmark_items):
    from pyspark.sql import functions as F

    docs = make_docs(["one", None]).withColumn(ADDED[name], F.lit("own"))
    out = by_row(name, benchmark_items)(docs)
    assert sorted(out.columns) == sorted(docs.columns) and dict(out.dtypes)[ADDED[name]] != "string"


def test_one_row_of_a_repeated_id_stays(spark, make_docs):
    pairs = [(1, "same text here"), (1, "same text here"), (2, "first of two"), (2, "second of two"), (3, "alone"), (None, "x"), (None, "x")]
    docs = make_docs(pairs)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    assert sorted((r["doc_id"] or 0) for r in kept) == [0, 0, 1, 2, 3]
    assert {r["text"] for r in kept if r["doc_id"] == 2} <= {"first of two", "second of two"}
    assert kept == corpus_pipeline.drop_near_duplicates(spark, docs.repartition(5), "").collect() or len(kept) == 5


def test_unlearned_languages_are_rejected(spark, make_docs):
    import random

    rng = random.Random(4)
    words = {"en": "the house with thing which and though ring".split(), "de": "der nicht schön über straße und zwischen ich".split()}
    texts = [(lang, " ".join(rng.choice(words[lang]) for _ in range(60))) for lang in words for _ in range(400)]
    greek = [(None, " ".join("".join(rng.choice("αβγδεζηθικλμνξοπρστυφχψω") for _ in range(6)) for _ in range(80))) for _ in range(40)]
    docs = make_docs([t for _, t in texts + greek], langs=[lang for lang, _ in texts + greek])
    kept = {r["doc_id"] for r in corpus_pipeline.identify_language(spark, docs, "").select("doc_id").collect()}
    assert len([i for i in kept if i < 800]) >= 790
    assert len([i for i in kept if i >= 800]) <= 10
