"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyriver.storage import shared_folder


def _stored(df: DataFrame) -> DataFrame:
    """``df`` written to and read from the shared folder: its lineage ends here."""
    spark = df.sparkSession
    path = shared_folder(spark, "edges")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Columns ``node`` and ``root``: every node of an edge with the smallest node it can reach, itself included.

    Rows with a null end are left out, and so are loops; repeated edges change nothing; an empty table gives an empty
    result. ``edges`` is evaluated once. The rounds grow with the logarithm of the longest path. Every round aggregates
    with combining minima, and its result is written to the shared folder, so a lost executor repeats one round at most.
    """
    ends = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    ordered = ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    stars, before = _stored(ordered.distinct()), None
    while True:
        stars = _stored(_small_star(_large_star(stars)))
        state = tuple(stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
    nodes = stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(stars.select("b", "b").distinct())
