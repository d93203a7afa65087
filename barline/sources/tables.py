"""Warehouse tables: load, write dispositions, ad-hoc SQL."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from barline.schema import LANDED
from barline.sources import versions
from barline.sources.files import read_bars_csv


class TableNotEmptyError(RuntimeError):
    """The table was expected to be empty."""


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def table_path(spark: SparkSession, table: str) -> str:
    """The folder of a table: its name within the folder of its database. Its versions lie inside."""
    database, name = table.rsplit(".", 1) if "." in table else (spark.catalog.currentDatabase(), table)
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{name}"


@dataclass(frozen=True)
class Buckets:
    """Layout of a table whose later windows and aggregates on ``key`` need no shuffle."""

    number: int
    key: str = "symbol"
    order: str = "trade_date"


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}


def _layout(described: Mapping[str, str]) -> Buckets | None:
    if not described.get("Num Buckets"):
        return None
    key, order = (described[c].strip("[]").replace("`", "").split(", ") for c in ("Bucket Columns", "Sort Columns"))
    return Buckets(int(described["Num Buckets"]), key[0], order[-1])


def point(spark: SparkSession, table: str, path: str, buckets: Buckets | None = None) -> None:
    """Let ``table`` name the Parquet files of ``path``.

    A name that has the same columns and layout already is moved in one step of the catalog; others are made anew.
    """
    schema = spark.read.parquet(path).schema
    if spark.catalog.tableExists(table):
        described = _described(spark, table)
        layout = _layout(described)
        same = (layout and layout.number) == (buckets and buckets.number) and spark.table(table).schema == schema
        if same and described.get("Type") != "VIEW":
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            spark.catalog.refreshTable(table)
            return
        spark.sql(f"DROP TABLE {table}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = f"CLUSTERED BY ({buckets.key}) SORTED BY ({buckets.order}) INTO {buckets.number} BUCKETS" if buckets else ""
    spark.sql(f"CREATE TABLE {table} ({columns}) USING PARQUET {by} LOCATION '{path}'")


def register(spark: SparkSession, table: str, buckets: Buckets | None = None) -> bool:
    """Let ``table`` name the current version in its folder; False if there is none.

    A catalog that lives no longer than its session forgets names, not files.
    """
    root = table_path(spark, table)
    last = versions.current(spark, root)
    if last is None:
        return False
    point(spark, table, f"{root}/{last.folders[table_name(table)]}", buckets)
    return True


def table_name(table: str) -> str:
    """The name of a table without its database."""
    return table.rsplit(".", 1)[-1]


def write_version(
    df: DataFrame,
    path: str,
    buckets: Buckets | None = None,
    name: str | None = None,
    observed: Mapping[str, Column] | None = None,
    hidden: Sequence[str] = (),
) -> dict[str, int]:
    """Write a new folder; the ``observed`` aggregates and the number of ``rows``.

    ``hidden`` columns are observed but not written. Bucketed files can only be written under a table's name, ``name``, which stays.
    """
    counted = Observation()
    out = df.observe(counted, F.count(F.lit(1)).alias("rows"), *(c.alias(n) for n, c in (observed or {}).items()))
    out = out.drop(*hidden)
    if buckets:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
        writer = out.write.option("compression", "zstd").bucketBy(buckets.number, buckets.key).sortBy(buckets.key, buckets.order)
        writer.option("path", path).format("parquet").mode("overwrite").saveAsTable(name)
    else:
        out.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return dict(counted.get)


def _add(df: DataFrame, table: str, observed: Mapping[str, Column] | None, accept: Callable[[Mapping[str, int]], None]) -> int:
    """Rows written beside a known table and, once accepted, added to its folder file by file."""
    spark = df.sparkSession
    described = _described(spark, table)
    buckets, home = _layout(described), described["Location"].rstrip("/")
    beside, name = f"{home}/_adding-{versions.new_version()}", f"{table}__adding"
    rows = df.select(*(F.col(f.name).cast(f.dataType) for f in spark.table(table).schema))
    moved: list[str] = []
    try:
        counts = write_version(rows, beside, buckets, name, observed)
        accept(counts)
        files, folder = versions.file_system(spark, beside)
        for status in files.listStatus(folder):
            file = status.getPath().getName()
            if not file.startswith(("_", ".")):
                if not versions.rename(spark, f"{beside}/{file}", f"{home}/{file}"):
                    raise versions.CommitError(f"{home}/{file} could not be added")
                moved.append(f"{home}/{file}")
    except Exception:
        for file in moved:
            versions.remove(spark, file)
        raise
    finally:
        if buckets:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        versions.remove(spark, beside)
        spark.catalog.refreshTable(table)
    return counts["rows"]


def write_table(
    df: DataFrame,
    table: str,
    disposition: str = "truncate",
    buckets: Buckets | None = None,
    observed: Mapping[str, Column] | None = None,
    accept: Callable[[Mapping[str, int]], None] = lambda counts: None,
) -> int:
    """Write a Parquet table and return the number of rows written.

    ``disposition`` is ``truncate`` (replace), ``append``, or ``empty`` (the table must be absent or have no rows). Versions
    lie in ``table_path``, whether or not this session knows the table yet. Rows are first written where no reader looks; then ``accept``
    is called with the ``observed`` aggregates and the number of ``rows``, and may raise. A replaced table changes by one commit:
    whatever fails before or after it, readers find all old rows. Appended files are added one by one.
    """
    spark, root = df.sparkSession, table_path(df.sparkSession, table)
    known = spark.catalog.tableExists(table) or (disposition != "truncate" and register(spark, table, buckets))
    if disposition == "empty" and known and not spark.table(table).isEmpty():
        raise TableNotEmptyError(table)
    if disposition != "truncate" and known:
        return _add(df, table, observed, accept)

    version, last, name = versions.new_version(), versions.current(spark, root), f"{table}__next"
    try:
        counts = write_version(df, f"{root}/{version}", buckets, name, observed)
        accept(counts)
        publish(spark, root, {table: (f"{root}/{version}", buckets)}, last)
    except Exception:
        versions.remove(spark, f"{root}/{version}")
        raise
    finally:
        if buckets:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    versions.prune(spark, root)
    return counts["rows"]


def publish(
    spark: SparkSession,
    root: str,
    named: Mapping[str, tuple[str, Buckets | None]],
    last: versions.Commit | None,
    facts: Mapping[str, Any] | None = None,
    keys: Mapping[str, str] | None = None,
) -> versions.Commit:
    """Commit folders under ``root``, then move the names of tables to them: all of them, or none.

    ``keys`` gives a table's key in the commit, by default its own name. If a name cannot be moved the commit is taken back and
    the names return to what they named before.
    """
    before = {t: _described(spark, t) for t in named if spark.catalog.tableExists(t)}
    folders = {(keys or {}).get(t, table_name(t)): path.removeprefix(f"{root}/") for t, (path, _) in named.items()}
    made = versions.commit(spark, root, folders, facts, last)
    moved: list[str] = []
    try:
        for table, (path, buckets) in named.items():
            moved.append(table)
            point(spark, table, path, buckets)
    except Exception:
        versions.retract(spark, root, made)
        for table in moved:
            if table in before:
                point(spark, table, before[table]["Location"], _layout(before[table]))
            else:
                spark.sql(f"DROP TABLE IF EXISTS {table}")
        raise
    return made


def load_bars(spark: SparkSession, csv_path: str, table: str, **layout: Any) -> int:
    """Replace ``table`` with the bars of CSV files; the loaded row count."""
    return write_table(read_bars_csv(spark, csv_path, LANDED), table, **layout)


def run_sql(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """The result of a SQL text; ``{name}`` in it stands for the frame passed under that name."""
    return spark.sql(text, **frames)


def union_batches(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of the batches, matched by column name."""
    for batch in others:
        first = first.unionByName(batch)
    return first
