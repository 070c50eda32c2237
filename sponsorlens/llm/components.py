"""Connected components of an edge table, by contraction.

Every node points at its smallest neighbour (or itself), pointers are followed
a few times, and the edges are renamed to where they lead; edges inside one node
go. Each round's tables are written to the shared folder. A node with very many
edges is one row of every pointer table, and the joins with it shuffle both
sides, so that Spark may split it.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b: long); the component is its smallest node."""
    edges = written(edges.filter(F.col("a") != F.col("b")).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = edges.select(F.col("a").alias("node"), F.col("a").alias("component")).limit(0)
    started = False
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = written(both.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("to")), "pointers")
        for _ in range(2):
            on = to.select(F.col("a").alias("to"), F.col("to").alias("further"))
            to = written(to.join(on, "to").select("a", F.col("further").alias("to")), "pointers")
        if started:
            on = to.select(F.col("a").alias("component"), "to")
            labels = written(labels.join(on, "component", "left").select("node", F.coalesce("to", "component").alias("component")), "labels")
        else:
            labels, started = to.select(F.col("a").alias("node"), F.col("to").alias("component")), True
        half = edges.join(to, "a").select(F.col("to").alias("x"), "b")
        whole = half.join(to.select(F.col("a").alias("b"), F.col("to").alias("y")), "b").filter("x <> y")
        edges = written(whole.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    return labels
