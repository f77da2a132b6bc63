"""Connected components of a graph that is a table of edges, by large-star and small-star rounds.

Each round replaces edges by edges to smaller nodes until every component is a star around
its smallest node. A round is two aggregates and two joins over edges; its result is written
to the shared scratch folder, so lineage stays short and a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regloom.session import scratch_path


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("c")).agg(F.least(F.min("b"), F.col("c")).alias("least"))
    return both.where("b > a").join(least, both["a"] == least["c"]).select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy(F.col("a").alias("c")).agg(F.min("b").alias("least"))
    linked = down.join(least, down["a"] == least["c"])
    ends = F.explode(F.array(F.struct(F.col("a"), F.col("least").alias("b")), F.struct(F.col("b").alias("a"), F.col("least").alias("b"))))
    return linked.select(ends.alias("e")).select("e.a", "e.b").where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) of every node that has an edge.

    ``edges`` has two columns of one orderable type, ``a`` and ``b``; loops and repeats do no
    harm, nulls are no nodes.
    """
    spark = edges.sparkSession
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    while True:
        path = scratch_path(spark, "components")
        now.write.parquet(path)
        now = spark.read.parquet(path)
        if _is_stars(now):
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        now = _small_star(_large_star(now))


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge to a smaller one and none to it, or only edges from larger ones.

    One aggregate, combined before its shuffle, instead of a round that changes nothing.
    """
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up"))
    ends = ends.unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    degrees = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return not degrees.where("down > 1 or (down = 1 and up = 1)").select(F.lit(1)).take(1)
