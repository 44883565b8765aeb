"""Connected components by repeated contraction, with stored rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import store


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b); label is the least node reachable.

    Each round hooks every node to its least neighbour, shortens the chains
    that arise, and contracts the edges to those between different hooks, so a
    group of copies linked to one representative takes a single round. Least
    neighbours come from partial aggregates; all joins are between stored
    tables, so adaptive execution can split a node with very many links.
    """
    live = store(
        edges.where("a <> b").select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).distinct(), "links"
    )
    labels = None
    while not live.isEmpty():
        both = live.unionByName(live.select(F.col("y").alias("x"), F.col("x").alias("y")))
        hook = store(both.groupBy("x").agg(F.min("y").alias("y")).select("x", F.least("x", "y").alias("y")), "hooks")
        for _ in range(2):
            up = hook.select(F.col("x").alias("y"), F.col("y").alias("z"))
            hook = store(hook.join(up, "y").select("x", F.col("z").alias("y")), "hooks")
        if labels is None:
            labels = hook.select(F.col("x").alias("node"), F.col("y").alias("label"))
        else:
            up = hook.select(F.col("x").alias("label"), F.col("y").alias("z"))
            labels = store(
                labels.join(up, "label", "left").select("node", F.coalesce("z", "label").alias("label")), "labels"
            )
        one = hook.select(F.col("x"), F.col("y").alias("p"))
        two = hook.select(F.col("x").alias("y"), F.col("y").alias("q"))
        live = store(
            live.join(one, "x").join(two, "y").where("p <> q")
            .select(F.greatest("p", "q").alias("x"), F.least("p", "q").alias("y")).distinct(),
            "links",
        )
    if labels is None:
        return live.select(F.col("x").alias("node"), F.col("y").alias("label"))
    return labels
