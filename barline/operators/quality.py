"""Data-quality checks and the gate that stops a build on a failing one."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# Shuffled bytes of keys and counts that one task of a check gets. Compressed keys take some twenty times as much in a hash table.
_KEY_BYTES = "4m"


class QualityError(RuntimeError):
    """A layer broke one of its declared constraints."""


@dataclass(frozen=True)
class Constraints:
    """Declared constraints of one layer."""

    not_null: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()


# The declared constraints of each layer.
LANDED_CONSTRAINTS = Constraints(not_null=("symbol", "date"))
STAGED_CONSTRAINTS = Constraints(not_null=("symbol", "trade_date"), unique=(("symbol", "trade_date"),))
SUMMARY_CONSTRAINTS = Constraints(not_null=("symbol",), unique=(("symbol",),))


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, failures): rows with a NULL, for all columns in one pass."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return counts.unpivot([], list(columns), "column_name", "failures")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with ``row_count``.

    Copies are counted before the shuffle, so a key with a huge number of copies moves as one
    row per input partition. A single-column key ignores NULL; a combined key compares it.
    """
    rows = df.filter(F.col(keys[0]).isNotNull()) if len(keys) == 1 else df
    return rows.groupBy(*keys).agg(F.count("*").alias("row_count")).filter(F.col("row_count") > 1)


def check(df: DataFrame, constraints: Constraints) -> DataFrame:
    """(check_name, column_name, failures) for every declared constraint, in one pass where the keys allow.

    The rows of each key serve both kinds if the columns that must not be NULL are among the key's.
    """
    keys = constraints.unique[0] if len(constraints.unique) == 1 else ()
    if keys and set(constraints.not_null) <= set(keys):
        groups = df.groupBy(*keys).agg(F.count("*").alias("__rows"))
        repeated = F.col("__rows") > 1
        if len(keys) == 1:
            repeated = repeated & F.col(keys[0]).isNotNull()
        failures = [
            ("not_null", c, F.coalesce(F.sum(F.when(F.col(c).isNull(), F.col("__rows"))), F.lit(0)))
            for c in constraints.not_null
        ]
        failures.append(("unique", ", ".join(keys), F.count_if(repeated)))
        return groups.agg(
            F.array(
                *(
                    F.struct(F.lit(kind).alias("check_name"), F.lit(name).alias("column_name"), count.alias("failures"))
                    for kind, name, count in failures
                )
            ).alias("found")
        ).select(F.inline("found"))
    results = []
    if constraints.not_null:
        nulls = null_violations(df, constraints.not_null)
        results.append(nulls.select(F.lit("not_null").alias("check_name"), "column_name", "failures"))
    for keys in constraints.unique:
        counted = duplicate_keys(df, keys).agg(F.count("*").alias("failures"))
        name = F.lit(", ".join(keys)).alias("column_name")
        results.append(counted.select(F.lit("unique").alias("check_name"), name, "failures"))
    return reduce(DataFrame.unionByName, results)


def null_counts(constraints: Constraints) -> dict[str, Column]:
    """Aggregates for ``write_table`` to observe: rows with a NULL, by column."""
    return {c: F.count_if(F.col(c).isNull()) for c in constraints.not_null}


def require_none(nulls: Mapping[str, int], layer: str) -> None:
    """Raise ``QualityError`` if an observed column had NULLs."""
    failed = [f"not_null({column}): {n}" for column, n in nulls.items() if n]
    if failed:
        raise QualityError(f"{layer}: {'; '.join(failed)}")


def with_repeats(df: DataFrame, key: str, when: str) -> tuple[DataFrame, str]:
    """Rows with a column of 1 on the second row of each (key, day), else 0, and that column's name; its sum counts repeated keys.

    ``when`` is a date or time. Rows that lie by ``key`` already are not moved again: neighbours in their order are compared.
    """
    name = "__repeated"
    in_order = Window.partitionBy(key).orderBy(when)
    day = F.col(when).cast("date")
    before = [F.lag(day, n).over(in_order) for n in (1, 2)]
    second = day.eqNullSafe(before[0]) & ~day.eqNullSafe(before[1]) & (F.row_number().over(in_order) > 1)
    return df.withColumn(name, second.cast("long")), name


def require_unique(repeated: int, constraints: Constraints, layer: str) -> None:
    """Raise ``QualityError`` if keys were counted that more than one row holds."""
    if repeated:
        raise QualityError(f"{layer}: unique({', '.join(constraints.unique[0])}): {repeated}")


@contextmanager
def _small_partitions(spark: SparkSession) -> Iterator[None]:
    """Let adaptive execution merge no more than ``_KEY_BYTES`` into a task, for as long as the block lasts."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, _KEY_BYTES)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def require(df: DataFrame, constraints: Constraints, layer: str) -> None:
    """Raise ``QualityError`` if ``layer`` breaks a constraint. Collects one row per constraint."""
    with _small_partitions(df.sparkSession):
        found = check(df, constraints).filter(F.col("failures") > 0).collect()
    failed = [f"{r.check_name}({r.column_name}): {r.failures}" for r in found]
    if failed:
        raise QualityError(f"{layer}: {'; '.join(failed)}")
