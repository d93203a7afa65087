"""The full chain: load, check, stage, metrics, then signals and summary."""

from __future__ import annotations

import logging
from dataclasses import dataclass
from datetime import date
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from barline.operators import cleaning, quality
from barline.operators.cleaning import clean_bars, date_range, judged_bars, rejections_of, stage_bars, staging_sql
from barline.operators.history import partitions_for
from barline.operators.signals import trade_signals
from barline.operators.summary import symbol_summary
from barline.plans import store
from barline.plans.metrics import daily_metrics
from barline.schema import PAYLOAD
from barline.session import scratch_path
from barline.sources.files import read_raw_csv, write_bars_csv
from barline.sources.payloads import NoDataError, bars_of, judged_records, rejected_of
from barline.sources import versions
from barline.sources.tables import Buckets, ensure_database, point, publish, table_name, write_version

log = logging.getLogger(__name__)

# Rejected symbols or values named in the log; the count is always complete.
_NAMED = 20


@dataclass(frozen=True)
class Layers:
    """Table names of one run and the rows loaded."""

    landed: str
    staged: str
    metrics: str
    signals: str
    summary: str
    loaded_rows: int


def _report(rejected: DataFrame, what: str) -> int:
    """Log how many rejections there are and the first of them."""
    number = rejected.count()
    if number:
        first = "; ".join(" ".join(map(str, row)) for row in rejected.limit(_NAMED).collect())
        log.warning("%d rejected %s, among them: %s", number, what, first)
    return number


def ingest_files(
    spark: SparkSession,
    source: str,
    target: str,
    rejected: str | None = None,
    start: date | None = None,
    end: date | None = None,
) -> bool:
    """Write the bars of stored payloads as CSV, and what was not used to ``rejected``.

    ``start`` and ``end`` restrict the days, both included. The source is read and parsed once; rejections are logged in any case. False, with
    ``target`` left alone, if no payload gave a bar.
    """
    path = scratch_path(spark, "judged")
    judged_records(spark.read.schema(PAYLOAD).parquet(source)).write.parquet(path)
    judged = spark.read.parquet(path)
    refused = rejected_of(judged)
    _report(refused, "payloads")
    if rejected:
        refused.write.mode("overwrite").option("header", True).csv(rejected)
    return write_bars_csv(date_range(bars_of(judged), start, end), target)


def _judged(raw: DataFrame, rejected: str | None) -> DataFrame:
    """Bars of raw ones; what cannot be read is reported. Raw bars are read, and their values judged, once."""
    path = scratch_path(raw.sparkSession, "judged")
    judged_bars(raw).write.parquet(path)
    judged = raw.sparkSession.read.parquet(path)
    refused = rejections_of(judged)
    _report(refused, "values")
    if rejected:
        refused.write.mode("overwrite").option("header", True).csv(rejected)
    return cleaning.bars_of(judged)


def clean_files(
    spark: SparkSession,
    source: str,
    target: str,
    files: int | None = None,
    rejected: str | None = None,
    start: date | None = None,
    end: date | None = None,
) -> bool:
    """Clean raw CSV files into CSV sorted by symbol and date; False if there was nothing to clean.

    Values that cannot be read become empty, are logged, and are listed in ``rejected``.
    """
    bars = _judged(read_raw_csv(spark, source), rejected)
    return write_bars_csv(date_range(bars, start, end), target, in_order=True, files=files)


def build_files(
    spark: SparkSession, source: str, namespace: str, location: str | None = None, rejected: str | None = None
) -> Layers:
    """``run_pipeline`` over raw CSV files; values that cannot be read are logged and listed in ``rejected``."""
    return build_layers(_judged(read_raw_csv(spark, source), rejected), namespace, location)


def store_files(
    spark: SparkSession, source: str, root: str, rejected: str | None = None, since: date | None = None
) -> versions.Commit:
    """Store the bars of raw CSV files and their metrics by year, or with ``since`` refresh a store from that day on. See ``plans.store``."""
    staged = stage_bars(_judged(read_raw_csv(spark, source), rejected))
    return store.refresh(staged, since, root) if since else store.store_bars(staged, root)


# Layers that are tables, and the database each lies in. Staging is a view.
_STORED = {"landed": "landing", "metrics": "intermediate", "signals": "marts", "summary": "marts"}


def _root(spark: SparkSession, namespace: str, location: str | None) -> str:
    return (location or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{namespace}").rstrip("/")


def _tables(spark: SparkSession, namespace: str, location: str | None) -> Layers:
    """The names of all layers, in databases at fixed folders."""
    root = _root(spark, namespace, location)

    def database(layer: str) -> str:
        name = f"{namespace}_{layer}"
        ensure_database(spark, name, f"{root}/{layer}")
        return name

    landing, staging, intermediate, marts = map(database, ("landing", "staging", "intermediate", "marts"))
    return Layers(
        f"{landing}.bars",
        f"{staging}.bars",
        f"{intermediate}.daily_metrics",
        f"{marts}.trade_signals",
        f"{marts}.symbol_summary",
        0,
    )


def _stage(spark: SparkSession, layers: Layers) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {layers.staged} AS {staging_sql(layers.landed)}")


def open_layers(spark: SparkSession, namespace: str, location: str | None = None) -> Layers:
    """Name the layers that the last complete run stored, in a session whose catalog does not know them or knows older ones."""
    layers, root = _tables(spark, namespace, location), _root(spark, namespace, location)
    last = versions.current(spark, root)
    if last is None:
        raise NoDataError(f"{namespace} has not been built")
    for layer in _STORED:
        buckets = Buckets(**last.facts["buckets"][layer]) if layer in last.facts["buckets"] else None
        point(spark, getattr(layers, layer), f"{root}/{last.folders[layer]}", buckets)
    _stage(spark, layers)
    return Layers(**{**vars(layers), "loaded_rows": last.facts["rows"]})


def run_pipeline(raw: DataFrame, namespace: str, location: str | None = None) -> Layers:
    """Rebuild every layer of ``namespace`` from raw bars; a failing check stops the run. See ``build_layers``."""
    return build_layers(clean_bars(raw), namespace, location)


def build_layers(cleaned: DataFrame, namespace: str, location: str | None = None) -> Layers:
    """Rebuild every layer of ``namespace`` from cleaned bars; a failing check stops the run.

    Staging is a view, the other layers are tables in one database each. A run writes new folders and makes them current by one
    commit when all are complete and checked, so readers see the layers of one run, and a run that fails anywhere leaves the last
    one as it was. Landed bars are shuffled by symbol once and stored in those buckets; metrics and summary then need no shuffle.
    Rows, missing keys and repeated days are counted while landing, before anything is computed from them.
    """
    spark = cleaned.sparkSession
    layers, root = _tables(spark, namespace, location), _root(spark, namespace, location)
    last, run = versions.current(spark, root), versions.new_version()
    number = max(partitions_for(cleaned), spark.sparkContext.defaultParallelism)
    buckets = {"landed": Buckets(number, order="date"), "metrics": Buckets(number)}
    folders = {layer: f"{root}/{base}/{table_name(getattr(layers, layer))}/{run}" for layer, base in _STORED.items()}
    # Names of the run's own tables, for as long as it lasts.
    names = {layer: f"{getattr(layers, layer)}__next" for layer in buckets}

    def write(layer: str, df: DataFrame, **observed: Any) -> dict[str, int]:
        return write_version(df, folders[layer], buckets.get(layer), names.get(layer), **observed)

    try:
        landed, repeats = quality.with_repeats(cleaned.repartition(number, "symbol"), "symbol", "date")
        counts = write(
            "landed",
            landed,
            observed={**quality.null_counts(quality.LANDED_CONSTRAINTS), repeats: F.sum(repeats)},
            hidden=[repeats],
        )
        if not counts["rows"]:
            raise NoDataError("no bars to work on")
        quality.require_none({c: counts[c] for c in quality.LANDED_CONSTRAINTS.not_null}, layers.landed)
        # Staging keeps rows and renames them, so its own columns are as complete as the landed ones.
        quality.require_unique(counts[repeats], quality.STAGED_CONSTRAINTS, layers.staged)

        write("metrics", daily_metrics(stage_bars(spark.table(names["landed"]))))
        metrics = spark.table(names["metrics"])
        write("signals", trade_signals(metrics))
        write("summary", symbol_summary(metrics))
        quality.require(spark.read.parquet(folders["summary"]), quality.SUMMARY_CONSTRAINTS, layers.summary)

        facts = {"rows": counts["rows"], "buckets": {layer: vars(b) for layer, b in buckets.items()}}
        named = {getattr(layers, layer): (folders[layer], buckets.get(layer)) for layer in _STORED}
        keys = {getattr(layers, layer): layer for layer in _STORED}
        publish(spark, root, named, last, facts, keys)
        _stage(spark, layers)
    except Exception:
        for folder in folders.values():
            versions.remove(spark, folder)
        raise
    finally:
        for name in names.values():
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    versions.prune(spark, root)
    return Layers(**{**vars(layers), "loaded_rows": counts["rows"]})
