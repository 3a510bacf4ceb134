"""Connected components of a graph given as rows of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.shared import lanes, removed, shared_folder


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; the component is its smallest node.

    Alternating large-star and small-star rounds (Kiveris et al. 2014): each node hands its larger
    neighbours, then its smaller ones, to the smallest node it sees. Only combined minima and links
    are shuffled; every round is written to the shared folder, so the plan stays short and a lost
    executor costs one round. The links end as stars; the number of rounds grows with the logarithm
    of the longest chain.
    """
    spark = links.sparkSession
    pair = F.col("a").cast("long"), F.col("b").cast("long")
    now = links.select(F.least(*pair).alias("a"), F.greatest(*pair).alias("b")).where("a < b").distinct()
    path = shared_folder(spark, "links")
    now.write.parquet(path)
    schema, mark = now.schema, None
    while True:
        now = spark.read.schema(schema).parquet(path)
        step = shared_folder(spark, "links")
        _small_star(_large_star(now)).write.parquet(step)
        removed(spark, path)
        path, before = step, mark
        mark = (
            spark.read.schema(schema).parquet(path)
            .agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        )
        if mark == before:
            break
    stars = spark.read.schema(schema).parquet(path)
    return stars.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component")).unionByName(
        stars.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    )


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return _pairs(both.where("b > a").join(_apart(least), "a").select(F.col("m").alias("a"), "b"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them (``a < b`` in every row)."""
    least = links.groupBy("b").agg(F.min("a").alias("m"))
    joined = links.join(_apart(least), "b")
    return _pairs(
        joined.select(F.col("m").alias("a"), F.col("a").alias("b")).unionByName(least.select(F.col("m").alias("a"), "b"))
    )


def _apart(least: DataFrame) -> DataFrame:
    """Minima dealt anew, so that the join shuffles both sides itself and a hub's links can be split."""
    return least.repartition(lanes(least.sparkSession))


def _pairs(links: DataFrame) -> DataFrame:
    return links.where("a < b").distinct()
