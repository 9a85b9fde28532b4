"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparvane.llm.common import materialize


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
    return row.n, row.h or 0


def thin(edges: DataFrame) -> DataFrame:
    """Edges with the same components, some two for each node: each node with its least neighbour, and that with its other smaller ones.

    For edges of which a node has a bounded number of smaller neighbours (one
    for each key it was filed under). Different keys of a group of copies name
    few different least members, so the pairs of these collapse before they move.
    """
    less = edges.where("u != v").groupBy(F.greatest("u", "v").alias("u")).agg(F.collect_set(F.least("u", "v")).alias("vs"))
    out = less.select(F.array_min("vs").alias("v"), F.explode(F.array_append("vs", F.col("u"))).alias("u"))
    return out.where("u != v").select("u", "v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v) long pairs -> (node, root): every node that has an edge, with the smallest node it reaches.

    Self-loops and repeated or reversed pairs do no harm; an empty edge table
    gives an empty result. Each round writes its edges to the shared folder;
    only their count and checksum come to the driver. The minimum over a
    node's neighbours is a partial aggregate and the join back is one that
    AQE can split, so a node with very many neighbours fills no single task.
    Nodes and edges never go out whole: all joins are by merge.
    """
    edges = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = materialize(edges, "edges")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low.hint("merge"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low.hint("merge"), "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        before, state = state, _state(edges)
        if before == state:
            break
    roots = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
