"""Connected components of a table of links, by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _least_neighbours(pairs: DataFrame) -> DataFrame:
    """(node, least): the least node among a node and its neighbours."""
    return pairs.groupBy("node").agg(F.min("other").alias("least")).select(
        "node", F.least("node", "least").alias("least")
    )


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select(F.col("child").alias("node"), F.col("parent").alias("other")).unionAll(
        links.select(F.col("parent").alias("node"), F.col("child").alias("other"))
    )


def _large_star(links: DataFrame, split_hubs: bool = False) -> DataFrame:
    """Every larger neighbour of a node is linked to the least one around that node."""
    pairs = _both_ways(links)
    least = _least_neighbours(pairs)
    if split_hubs:
        # Two plain tables: the join can then split a hub's neighbours over tasks.
        least = materialise(least, "least")
    joined = pairs.join(least, "node").where(F.col("other") > F.col("node"))
    return joined.select(F.col("other").alias("child"), F.col("least").alias("parent")).distinct()


def _small_star(links: DataFrame, split_hubs: bool = False) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    pairs = links.select(F.col("child").alias("node"), F.col("parent").alias("other"))
    least = _least_neighbours(pairs)
    if split_hubs:
        least = materialise(least, "least")
    moved = pairs.join(least, "node").select(F.col("other").alias("child"), F.col("least").alias("parent"))
    kept = least.select(F.col("node").alias("child"), F.col("least").alias("parent"))
    return moved.unionAll(kept).where(F.col("child") != F.col("parent")).distinct()


def _is_stars(links: DataFrame) -> bool:
    """Whether every child has one parent and no parent is a child."""
    ends = links.select(F.col("child").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        links.select(F.col("parent").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    per_node = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    broken = per_node.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))
    return broken.isEmpty()


def connected_components(links: DataFrame, split_hubs: bool = False) -> DataFrame:
    """(node, component) of every node with a link; the component is its smallest node.

    ``links`` has columns ``a`` and ``b`` of one orderable type.  Nulls and links of a node to
    itself count for nothing; repeated links and both directions count once; no links give no
    rows.  Every round is written to the shared folder, so it never replays earlier rounds.  A
    node's neighbours are reduced by aggregation and join and are never gathered into one row; with
    ``split_hubs`` the joins can also split the neighbours of one node over many tasks.
    """
    links = links.where("a is not null and b is not null and a <> b")
    links = links.select(F.greatest("a", "b").alias("child"), F.least("a", "b").alias("parent")).distinct()
    links = materialise(links, "links")
    while not _is_stars(links):
        links = materialise(_small_star(_large_star(links, split_hubs), split_hubs), "links")
    return links.select(F.col("child").alias("node"), F.col("parent").alias("component")).unionAll(
        links.select(F.col("parent").alias("node"), F.col("parent").alias("component")).distinct()
    )
