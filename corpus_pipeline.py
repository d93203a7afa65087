"""From raw documents to packed training windows, in five stages that each read what the one before wrote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from barline.llm import decontamination, language, line_dedup, near_dedup, packing
from barline.llm.components import stored
from barline.llm.queries import share_package
from barline.llm.text import fresh
from barline.session import intermediates, scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Not expressible in SQL: trained network, sketches, packing. tests/llm holds brute-force versions.
ORACLE_SQL: str | None = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; texts without a letter and null texts go, rows that repeat stay.

    The network learns from the labelled documents of the input. A text goes if its windows are less certain of a language than
    nearly all labelled texts set aside from training. Without two languages to learn
    from there is nothing to tell apart, and only texts without a letter go.
    """
    share_package(spark)
    network = language.train(language.training_sample(docs))
    if not network.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    into = fresh("language")
    known = (F.col(into)["lang"] != language.UNKNOWN) & (F.col(into)["certain"] >= network.least_certain)
    return language.identify(docs, network, into=into).filter(known).drop(into)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines repeated across documents; the first occurrence of each stays.

    Lines of ten documents or more are repeated. Documents whose lines were all repeated ones go; null and empty texts, which have
    no line of their own, stay as they are, and so does every row of a repeated id.
    """
    bitmaps = line_dedup.keep_bitmaps(docs, keep_first=True)
    lines = fresh("lines")
    done = line_dedup.apply_bitmaps(docs, bitmaps, into=lines)
    kept = F.col(lines)["kept"]
    changed = F.col(lines)["n_dropped"] > 0
    emptied = changed & (F.char_length(F.btrim(kept, F.lit(line_dedup.BLANKS))) == 0)
    out = done.filter(~emptied).withColumn("text", F.when(changed, kept).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.drop(lines)


def one_row_per_id(docs: DataFrame) -> DataFrame:
    """One row of each id, rows without one aside: of several the first by a hash of all columns. Only rows of repeated ids move."""
    counted = docs.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias(fresh("n")))
    repeated = stored(counted.filter(F.col(counted.columns[1]) > 1).select("doc_id"), "repeated-ids")
    if repeated.isEmpty():
        return docs
    row = fresh("row")
    several = docs.join(repeated, "doc_id", "left_semi")
    first = several.groupBy("doc_id").agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias(row))
    return docs.join(repeated, "doc_id", "left_anti").select(docs.columns).union(first.select(f"{row}.*"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id, and one row of it.

    Texts without words are in no group; rows without an id are not compared and stay.
    """
    share_package(spark)
    single = one_row_per_id(docs)
    classes = near_dedup.near_duplicates(single)
    gone = classes.filter(F.col("doc_id") != F.col("component_id")).select("doc_id")
    return single.join(gone, "doc_id", "left_anti").select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage; null and empty texts have none."""
    share_package(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    into = fresh("hits")
    hits = decontamination.benchmark_hits(docs, benchmark, into=into)
    return hits.filter(decontamination.hit_words(F.col(into)) == 0).drop(into)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training windows, by similarity of the documents. Every row is packed, null and empty texts as a closing id."""
    share_package(spark)
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_windows),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is written and read again, and what the stage stored on the way removed."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        with intermediates(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
