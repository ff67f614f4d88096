"""Connected components of a link table, by alternating star contraction.

Every round points the larger neighbours of a node (large star), then the
smaller ones (small star), to the smallest node it knows; long chains shrink
quickly and every step is an aggregate and a join of the link table. Nothing
is collected; the table is written between rounds, and a round's tables are
deleted when the next is written. Nodes of many links (hubs of large clusters)
are joined by a broadcast of at most 20,000 rows, so no task gets all of a hub's links.
An empty table gives no rows; repeated links and loops count for nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gable.llm.common import discard, materialise

_HUBS = 10_000  # hubs are nodes of more than links / _HUBS links: 2 * _HUBS at most


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _star(pairs: DataFrame, count: int, keep_self: bool) -> DataFrame:
    """Point every v of a node u, and u itself if asked, to the least of them."""
    known = materialise(pairs.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("links")).select(
        "u", F.least("u", "m").alias("m"), (F.col("links") > max(1000, count // _HUBS)).alias("hub")))
    hubs = F.broadcast(known.where("hub").select("u", "m"))
    rest = pairs.join(hubs.select("u"), "u", "left_anti").join(known.where("not hub").select("u", "m"), "u")
    moved = pairs.join(hubs, "u").union(rest).select(F.col("v").alias("u"), F.col("m").alias("v"))
    out = materialise((moved.union(known.select("u", F.col("m").alias("v"))) if keep_self else moved).where("u > v").distinct())
    discard(known)
    return out


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every linked node.

    ``links`` has two columns of longs, in any order and with repeats.
    """
    a, b = links.columns
    edges = materialise(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct())
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, 2 * state[0], keep_self=False)
        small = _star(large, state[0], keep_self=True)
        discard(large, edges)
        edges, before = small, state
        state = _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots).distinct()
