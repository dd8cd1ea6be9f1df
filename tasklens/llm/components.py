"""Connected components of a link table by alternating stars, in rounds of joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasklens.llm.staging import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """Smallest member of every component. Links have columns a and b; returns node and component, for linked nodes.

    Each round points all larger neighbours of a node at the smallest one (large star), then all smaller ones (small
    star), until nothing changes. Minima are combined before the shuffle, so a hub costs one row per map task there.
    Links with a null end and links of a node to itself are left out; repeated links count once.
    """
    pairs = links.filter("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("node"), F.least("a", "b").alias("parent"))
    pairs = materialize(pairs.distinct())
    state = None
    while True:
        pairs = materialize(_small_star(_large_star(pairs)))
        now = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "parent"))).first()
        if now == state:
            return pairs.select("node", F.col("parent").alias("component"))
        state = now


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.unionByName(pairs.select(F.col("parent").alias("node"), F.col("node").alias("parent")))
    smallest = both.groupBy("node").agg(F.min("parent").alias("low"))
    joined = both.join(smallest, "node").filter("parent > node")
    return joined.select(F.col("parent").alias("node"), F.least("low", "node").alias("parent")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    smallest = pairs.groupBy("node").agg(F.min("parent").alias("low"))
    joined = pairs.join(smallest, "node")
    moved = joined.filter("parent > low").select(F.col("parent").alias("node"), F.col("low").alias("parent"))
    return smallest.select("node", F.col("low").alias("parent")).unionByName(moved).distinct()
