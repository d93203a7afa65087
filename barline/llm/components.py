"""Connected components of a link table, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from barline.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """A table written to the shared folder: lineage ends here, and lost executors cost no recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def connected(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b); the component is its smallest id.

    Each round every id takes the smallest label among its neighbours and then that label's own
    label, so chains shorten by half or more a round. Rounds end when no label changes. Joins on ids with many links are
    split by adaptive execution; minima are aggregated before they shuffle.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct(), "links")
    labels = both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.min("a")).alias("component"))
    total = None
    while True:
        labels = stored(labels, "labels")
        now = labels.agg(F.sum(F.col("component").cast("decimal(38,0)"))).first()[0]
        if now == total:
            return labels
        total = now
        sent = both.join(labels, both["a"] == labels["id"]).select(F.col("b").alias("id"), "component")
        lowest = labels.union(sent).groupBy("id").agg(F.min("component").alias("component"))
        own = labels.select(F.col("id").alias("component"), F.col("component").alias("further"))
        jumped = lowest.join(own, "component").select("id", F.least("component", "further").alias("component"))
        labels = jumped
