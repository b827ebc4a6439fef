"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanledger.llm.common import stored


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free sum of the edges; equal for equal edge sets."""
    found = F.xxhash64("a", "b").bitwiseAND(F.lit((1 << 40) - 1))
    return tuple(edges.agg(F.count("*"), F.sum(found)).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)``: the smallest node that it reaches.

    Large-star and small-star rounds: each node links what it sees to the
    smallest node it sees, until nothing changes; that takes a number of rounds
    about logarithmic in the size of a component. All steps are joins and
    aggregates on edges, so a node with very many links stays distributed, and
    each round is written to the shared folder. Loops and repeated edges do no
    harm; an edge with a null end is ignored; no edges give no rows.
    """
    edges = stored(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    before = _mark(edges)
    while before[0]:
        edges = stored(_small_star(_large_star(edges)), "edges")
        after = _mark(edges)
        if after == before:
            break
        before = after
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return leaves.unionByName(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to its smallest neighbour or itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    larger = both.filter("b > a").join(least, "a")
    return larger.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    others = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
