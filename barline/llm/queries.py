"""The registered queries: operators with production parameters, over whole tables."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barline.llm import (
    decontamination,
    html_text,
    language,
    lexical_search,
    licenses,
    line_dedup,
    near_dedup,
    packing,
    quality,
    secrets,
    token_alignment,
    token_counts,
    toxicity,
)
from barline.session import scratch_path
from barline.sources import versions

Query = Callable[[SparkSession, str], DataFrame]
TOKEN_LIMIT = 512


# Rows of a batch between Spark and Python: texts are long, and both sides hold a batch or two.
BATCH_ROWS = 1_000
# Applications whose workers have the package.
_shared: set[str] = set()


def share_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of every executor, once an application, and texts to them in small batches.

    The batch size is a setting of the session; it stays, as queries run after this returns.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    context = spark.sparkContext
    if context.applicationId in _shared:
        return
    package = Path(__file__).resolve().parents[1]
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    path = f"{scratch_path(spark, 'package')}.zip"
    files, target = versions.file_system(spark, path)
    stream = files.create(target, False)
    try:
        stream.write(content.getvalue())
    finally:
        stream.close()
    context.addPyFile(path)
    _shared.add(context.applicationId)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    share_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")


def _fold(n: int) -> Column:
    """The fold of a document, 0 to n - 1, by the checksum of its id as text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(n))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").filter(_fold(5) != 0)
    model = toxicity.fit(toxicity.training_sample(docs, labels))
    scored = toxicity.toxicity(docs, model)
    score = F.col("toxicity.score")
    return scored.select(
        "doc_id",
        (_fold(5) == 0).alias("held_out"),
        score.alias("score"),
        (score >= 0.5).cast("int").alias("predicted"),
        F.col("toxicity.n_words").alias("n_words"),
        F.size("toxicity.passages").cast("long").alias("n_passages"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    done = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    return done.select(
        "doc_id", "lines.n_lines", "lines.n_dropped", F.sha2(F.col("lines.kept"), 256).alias("kept_sha256")
    )


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality(_documents(spark, sf_dir))
    return judged.select("doc_id", "quality.*")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return licenses.license_scan(docs, run=licenses.RUN).select("doc_id", "license.*")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.token_counts(_documents(spark, sf_dir).select("doc_id", "text"), TOKEN_LIMIT)
    n = F.col("tokens.n_tokens")
    return counted.select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        n.alias("n_tokens"),
        (n > TOKEN_LIMIT).alias("over_limit"),
        F.col("tokens.fitting_chars").alias("fitting_chars"),
        F.octet_length("tokens.prefixes").cast("long").alias("stored_bytes"),
    )


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    network = language.train(language.training_sample(docs, _fold(4) != 2))
    return language.identify(docs.select("doc_id", "text"), network).select(
        "doc_id",
        (_fold(4) == 2).alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    hits = decontamination.benchmark_hits(docs, _table(spark, sf_dir, "benchmark"))
    n_hit = decontamination.hit_words(F.col("hits"))
    return hits.select(
        "doc_id",
        F.col("hits.n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("hits.items"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(_documents(spark, sf_dir).select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["kind"].isin(*secrets.BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(count(kind) for kind in secrets.BASE),
        F.sha2(secrets.listed(base), 256).alias("base_sha256"),
        secrets.listed(F.col("secrets")).alias("spans"),
    )


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = near_dedup.near_duplicates(_documents(spark, sf_dir).select("doc_id", "text"), similarity=0.85)
    return classes.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return lexical_search.ranked_search(docs, _table(spark, sf_dir, "benchmark")).select("item_id", "rank", "doc_id", "score")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(_documents(spark, sf_dir).select("doc_id", "text"))


def op13_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.main_text(pages).select("page_id", "url", "content.text", "content.n_chars")


def queries() -> dict[str, Query]:
    named = (
        op1_toxicity,
        op2_line_dedup,
        op3_quality,
        op4_packing,
        op5_license_scan,
        op6_token_counts,
        op7_language_id,
        op8_decontamination,
        op9_secrets,
        op10_near_dedup,
        op11_lexical_search,
        op12_token_alignment,
        op13_html_text,
    )
    return {f.__name__: f for f in named}
