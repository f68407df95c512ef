"""Connected components by repeated contraction of the edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridelake.llm.common import steps, stored


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of ``edges (a, b)``; the component is its smallest node.

    Each round points every node to its smallest neighbour (or itself), shortens the pointers twice and contracts the
    edges to the targets. Every node that is no local minimum disappears, so the edge table at least halves; the
    pointer tables are then followed backwards. All minima are aggregated before their shuffle, all joins have one
    side with one row per node, so a hub with a third of all edges is only a skewed join side that Spark splits.
    """
    with steps() as keep:
        live = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
                      "edges")
        pointers: list[DataFrame] = []
        while not live.isEmpty():
            if len(pointers) == max_rounds:
                raise RuntimeError(f"components need more than {max_rounds} rounds")
            both = live.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
                live.select(F.col("b").alias("node"), F.col("a").alias("other")))
            to = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("to"))
            to = stored(to, "pointers")
            for _ in range(2):
                step = to.select(F.col("node").alias("to"), F.col("to").alias("next"))
                to = to.join(step, "to").select("node", F.col("next").alias("to"))
            to = stored(to, "pointers")
            pointers.append(to)
            # a target that is itself pointed onwards stays linked to its own target
            chain = to.select("to").distinct().join(to.select(F.col("node").alias("to"), F.col("to").alias("y")), "to")
            ends = to.select(F.col("node").alias("a"), F.col("to").alias("x"))
            live = live.join(ends, "a").select("b", "x")
            live = live.join(to.select(F.col("node").alias("b"), F.col("to").alias("y")), "b").select("x", "y")
            live = live.unionByName(chain.select(F.col("to").alias("x"), "y")).where("x <> y")
            live = stored(live.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        if not pointers:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).limit(0)
        labels = pointers[-1].withColumnRenamed("to", "component")
        for to in reversed(pointers[:-1]):
            last = labels.select(F.col("node").alias("to"), F.col("component").alias("last"))
            labels = to.join(last, "to", "left").select("node", F.coalesce("last", "to").alias("component"))
        return keep(stored(labels, "components"))
