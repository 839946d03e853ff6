"""Connected components of a graph that no single machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from celltide.llm.frames import materialize


def _least(sym: DataFrame) -> DataFrame:
    """For each node u the least of u and its neighbours."""
    return sym.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node are linked to the least node around it."""
    sym = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (
        sym.join(_least(sym), "u").where("v > u")
        .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    return (
        down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .union(low.select("u", F.col("m").alias("v"))).distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge; the root is the least node of the component.

    `edges` has two columns of one ordered type. Nodes without edges are not listed. Large and small
    stars alternate until the edges are stars around the roots; a node with very many neighbours is
    only ever aggregated or joined, never gathered. Each round is written to the shared folder.
    Null ends and loops are left out; repeated edges count once.
    """
    a, b = edges.columns[:2]
    now = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    before = None
    while True:
        seen = Observation()
        now = materialize(
            _small_star(_large_star(now)).observe(
                seen, F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
            ), "stars",
        )
        if (got := (seen.get["n"], seen.get["h"])) == before or not got[0]:
            break
        before = got
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return nodes.union(roots)
