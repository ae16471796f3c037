"""Connected components of an edge table by repeated hooking and pointer jumping.

A round hooks every node to its smallest smaller neighbour (a min aggregate, combined map
side), jumps pointers until each hooked node points at its root (doublings, so a path of n
nodes takes log n joins), then contracts the edges to the roots. Rounds end when no edge
joins two roots. State is three narrow tables, written to the shared folder after each step.
Joins read written tables on both sides, so Spark can split the partition of a hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def connected_components(edges: DataFrame, a: str, b: str, scratch: Scratch) -> DataFrame:
    """``node, component`` for each node of ``edges``; component = the smallest node of its group.

    Ids may be of any orderable type. Edges with a null end are ignored; a self edge names
    a node; repeated edges count once; no edges give no rows."""
    both = edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v"),
                        F.col(a).isNotNull().alias("x"), F.col(b).isNotNull().alias("y"))
    links = scratch.save(both.where("x and y").select("u", "v").distinct(), "edges")
    labels = scratch.save(links.select(F.explode(F.array("u", "v")).alias("node")).distinct()
                          .select("node", F.col("node").alias("component")), "labels")
    links = links.where("u < v")
    while not links.isEmpty():
        hooks = scratch.save(links.groupBy(F.col("v").alias("n")).agg(F.min("u").alias("p")), "hooks")
        while True:
            up = hooks.select(F.col("n").alias("m"), F.col("p").alias("q"))
            jumped = scratch.save(hooks.join(up, F.col("p") == F.col("m"), "left")
                                  .select("n", F.coalesce("q", "p").alias("p"),
                                          F.col("q").isNotNull().alias("moved")), "jump")
            scratch.drop(hooks)
            hooks = jumped
            if hooks.where("moved").isEmpty():
                break
            # a hook that did not move has reached its root
        h1 = hooks.select(F.col("n").alias("n1"), F.col("p").alias("p1"))
        h2 = hooks.select(F.col("n").alias("n2"), F.col("p").alias("p2"))
        new_labels = scratch.save(
            labels.join(h1, F.col("component") == F.col("n1"), "left")
            .select("node", F.coalesce("p1", "component").alias("component")), "labels")
        new_links = scratch.save(
            links.join(h1, F.col("u") == F.col("n1"), "left").join(h2, F.col("v") == F.col("n2"), "left")
            .select(F.coalesce("p1", "u").alias("x"), F.coalesce("p2", "v").alias("y")).where("x <> y")
            .select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")).distinct(), "edges")
        scratch.drop(hooks, labels)
        labels, links = new_labels, new_links
    return labels
