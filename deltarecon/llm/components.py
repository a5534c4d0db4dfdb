"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deltarecon.session import materialize_to, remove_path, scratch_path


def _pointed(edges: DataFrame) -> DataFrame:
    """Each link once, from the larger node to the smaller."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()


def _contract(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Links every node to the least node among its neighbours.

    ``both_ways``: larger neighbours move to that node; else the node itself
    and its smaller neighbours do. The least is a partial aggregate and the
    join's other side has one row a node, so a hub splits as a skewed join.
    """
    links = edges.union(edges.select("b", "a")) if both_ways else edges
    least = links.groupBy(F.col("a").alias("hub")).agg(F.min("b").alias("least"))
    least = least.select("hub", F.least("hub", "least").alias("least"))
    joined = links.join(least, links["a"] == least["hub"])
    if both_ways:
        moved = joined.filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).union(
            least.select(F.col("hub").alias("a"), F.col("least").alias("b")))
    return _pointed(moved)


def _fingerprint(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], r["s"]


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the links ``(a, b)``; root is the
    least node of its component. Every round is written to the shared folder,
    and only two numbers a round reach the driver. No links: no rows."""
    spark = edges.sparkSession
    path = scratch_path(spark, "links")
    edges = materialize_to(_pointed(edges), path)
    seen = _fingerprint(edges)
    while seen[0]:
        before, path = path, scratch_path(spark, "links")
        edges = materialize_to(_contract(_contract(edges, True), False), path)
        remove_path(spark, before)  # the links before are read no more
        now = _fingerprint(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
