"""Connected components of a link table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: every neighbour that is larger (or not larger) than ``u`` is linked to
    the least node around ``u``. ``edges`` has both directions."""
    least = edges.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    side = F.col("v") > F.col("u") if large else F.col("v") <= F.col("u")
    moved = edges.filter(side).join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not large:
        moved = moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.filter("a <> b").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every ``a`` has one ``b``, which is no ``a`` itself: then each ``b`` is the least
    node of its component. One aggregate, which a hub enters as one row a task."""
    nodes = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    sums = nodes.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return sums.filter("up + down > 1 and up > 0").isEmpty()


def merged_components(roots: DataFrame, links: DataFrame, key: str, a: str = "a", b: str = "b") -> DataFrame:
    """``roots`` (``key``, ``root``) after more ``links`` between keys: components are found among
    the roots that the new links join, and the other rows are carried over. Keys that were in no
    component before come in by their links."""
    named = links.select(F.col(a).alias("a"), F.col(b).alias("b"))
    for end in ("a", "b"):
        known = roots.select(F.col(key).alias(end), F.col("root").alias("__root"))
        named = named.join(known, end, "left").withColumn(end, F.coalesce("__root", end)).drop("__root")
    joined = materialise(components(named), "joined")
    known = roots.select(key, "root")
    fresh = joined.select(F.col("node").alias(key)).join(known.select(key), key, "left_anti")
    every = known.unionByName(fresh.select(key, F.col(key).alias("root")))
    top = joined.select(F.col("node").alias("root"), F.col("root").alias("__top"))
    return every.join(top, "root", "left").select(key, F.coalesce("__top", "root").alias("root"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root`` (the least node of its component) for every node of ``links``.

    Alternating star steps: every round pulls each node closer to the least one, so the
    number of rounds grows with the logarithm of the longest chain. A hub's links are
    reduced to a minimum before the shuffle. Each round is written below the shared folder.
    Links without one of the ends and links of a node with itself say nothing.
    """
    edges = (
        links.select(F.col(a).alias("a"), F.col(b).alias("b"))
        .filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    edges = materialise(edges, "links")
    while not _are_stars(edges):
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        grown = materialise(_star(both, large=True), "links")
        pairs = grown.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        edges = materialise(_star(pairs, large=False), "links")
    return (
        edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")))
        .distinct()
    )
