"""Connected components of a graph given as edges, by alternating star contractions.

Each round hangs the larger neighbours of a node on its smallest neighbour, then the smaller ones. Rounds grow
with the logarithm of the nodes. Only two figures of each round (edges, checksum) reach the driver; the edges
of a round are a written table, so a lost executor costs no earlier round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _star(pairs: DataFrame) -> DataFrame:
    """Links each ``b`` (and ``a``) of a node ``a`` to the smallest of them all; one link per larger node."""
    least = pairs.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    joined = pairs.join(least, "a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b"))


def components(edges: DataFrame, name: str = "edges") -> DataFrame:
    """``node``, ``root`` (the smallest node reachable) for every node of the edges ``a``, ``b`` (longs).

    Self-links and repeats are allowed; no edges give no rows. Nodes that are their own root have a row too.
    """
    now = common.stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name
    )
    nodes = now
    state = _state(now)
    while state[0]:
        both = now.filter("a != b")
        both = both.union(both.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both).filter("a > b")
        small = large.distinct()
        least = small.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            small.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
            .filter("a > b").distinct()
        )
        after = common.stored(small, name)
        reached = _state(after)
        if now is not nodes:
            common.dropped(now)
        now, done, state = after, reached == state, reached
        if done:
            break
    every = nodes.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("root")).filter("node > root")
    out = every.join(stars, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    out = common.stored(out, name)
    common.dropped(nodes, now)
    return out
