"""Connected components of an edge table by alternating star contractions.

Each round points every node at the smallest node it can see; the number of rounds grows with the
logarithm of the longest path. Minima are combined on the map side, and edges of a hub are split by
adaptive skew joins, so a giant component does not end in one task.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentry.session import checkpointed


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour larger than a node is linked to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = both.groupBy("src").agg(F.min("dst").alias("_m"))
    root = F.least("_m", "src")
    larger = both.where(F.col("dst") > F.col("src"))
    return larger.join(least, "src").select(F.col("dst").alias("src"), root.alias("dst")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them (src > dst in every edge)."""
    least = edges.groupBy("src").agg(F.min("dst").alias("_m"))
    rest = edges.join(least, "src").where(F.col("dst") != F.col("_m"))
    return (
        rest.select(F.col("dst").alias("src"), F.col("_m").alias("dst"))
        .unionByName(least.withColumnRenamed("_m", "dst"))
        .distinct()
    )


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def _in_one_task(table: pa.Table) -> pa.Table:
    """Components by union-find."""
    up: dict = {}

    def root(x):
        while (y := up.setdefault(x, x)) != x:
            up[x] = up[y]
            x = up[x]
        return x

    for a, b in zip(table.column("src").to_pylist(), table.column("dst").to_pylist()):
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    nodes, kind = list(up), table.schema.field("src").type
    return pa.table({"node": pa.array(nodes, kind), "root": pa.array(map(root, nodes), kind)})


def connected_components(edges: DataFrame, src: str, dst: str, task_edges: int = 0) -> DataFrame:
    """``node``, ``root`` for every node of some edge; the root is the smallest node of its component.

    Up to ``task_edges`` edges are counted and then solved in one task; beyond, by rounds, with the same result.
    Nodes of one task are compared by Python: whole numbers, strings and bytes have the order that Spark gives them.
    """
    edges = edges.select(F.greatest(src, dst).alias("src"), F.least(src, dst).alias("dst"))
    if task_edges:
        edges = checkpointed(edges)
        if edges.count() <= task_edges:
            kind = edges.schema["src"].dataType.simpleString()
            return edges.coalesce(1).groupBy(F.lit("all")).applyInArrow(_in_one_task, f"node {kind}, root {kind}")
    own = edges.select(F.col("dst").alias("node")).unionByName(edges.select(F.col("src").alias("node"))).distinct()
    links = checkpointed(edges.where(F.col("src") != F.col("dst")).distinct())
    state = _state(links)
    while True:
        links = checkpointed(_small_star(_large_star(links)))
        reached = _state(links)
        if reached == state:
            break
        state = reached
    roots = links.select(F.col("src").alias("node"), F.col("dst").alias("root"))
    return own.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
