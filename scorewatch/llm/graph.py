"""Connected components of links between integers, and tables kept in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewatch.session import scratch_folder


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame below spark.checkpoint.dir and read it back, which cuts its lineage."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(links: DataFrame) -> DataFrame:
    """(node, component) of links (a, b), the component being its smallest node.

    Large-star and small-star rounds: every node points its neighbours to the smallest it
    knows, until nothing changes. The work of a round is one aggregation and one join over
    the links; a node with very many links is a few partial minima and a split join.
    """
    edges = stage(links.select("a", "b").where("a <> b").distinct(), "links")
    state = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("least"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = stage(small.union(least.select("a", F.col("least").alias("b"))).where("a <> b").distinct(), "links")
        sign = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sign == state:
            return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
        state = sign
