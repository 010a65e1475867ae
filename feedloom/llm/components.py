"""Connected components of a graph that no single machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import Scratch


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, component) for every end of a link; a component is its smallest node.

    ``links`` has two columns of node numbers. Rows with a NULL end and links of
    a node to itself are ignored, repeated links count once, no link gives no
    row.

    Alternating large and small stars: every round links the larger neighbours
    of a node to its smallest neighbour, then the smaller ones. It ends when
    each node but the smallest of a component has one link, to that smallest
    one; the number of rounds grows with the logarithm of the number of nodes.
    Minima are partial aggregates and joins are plain equi-joins, whose hot
    keys adaptive execution splits. Each round is written to the shared folder.
    """
    scratch = Scratch(spark)
    a, b = (F.col(name) for name in links.columns)
    edges = scratch.write(
        links.select(F.least(a, b).alias("low"), F.greatest(a, b).alias("high"))
        .where("low < high AND low IS NOT NULL AND high IS NOT NULL")
        .distinct(),
        "links",
    )
    while _unfinished(edges):
        following = scratch.write(_round(edges), "links")
        scratch.drop(edges)
        edges = following
    roots = edges.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    return roots.union(edges.select(F.col("high").alias("node"), F.col("low").alias("component")))


def _ends(edges: DataFrame) -> DataFrame:
    return edges.select(
        F.explode(
            F.array(
                F.struct(F.col("low").alias("node"), F.col("high").alias("other")),
                F.struct(F.col("high").alias("node"), F.col("low").alias("other")),
            )
        ).alias("end")
    ).select("end.*")


def _unfinished(edges: DataFrame) -> bool:
    """Whether a node has two smaller neighbours, or a smaller and a larger one."""
    per_node = (
        _ends(edges)
        .groupBy("node")
        .agg(
            F.count(F.expr("CASE WHEN other < node THEN 1 END")).alias("smaller"),
            F.count(F.expr("CASE WHEN other > node THEN 1 END")).alias("larger"),
        )
    )
    return not per_node.where("smaller > 1 OR (smaller = 1 AND larger > 0)").isEmpty()


def _round(edges: DataFrame) -> DataFrame:
    least = _ends(edges).groupBy("node").agg(F.min("other").alias("least")).where("least < node")
    large = (
        edges.join(least, edges["low"] == least["node"], "left")
        .select(F.col("high"), F.coalesce("least", "low").alias("low"))
        .distinct()
    )
    least = large.groupBy("high").agg(F.min("low").alias("least"))
    small = large.join(least.withColumnRenamed("high", "node"), F.col("high") == F.col("node")).where("low > least")
    return (
        small.select(F.col("least").alias("low"), F.col("low").alias("high"))
        .union(least.select(F.col("least").alias("low"), F.col("high")))
        .distinct()
    )
