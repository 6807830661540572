"""Connected components of an undirected graph, with DataFrame operations only.

Alternating large-star and small-star rounds: each round replaces a node's
links by links to the smallest neighbour, until every node links to the
smallest node of its component and to nothing else. Rounds grow with the
logarithm of the longest path. Minima are pre-aggregated in each task; they
are written before they are joined back, so that both sides of the join come
straight from a shuffle and Spark splits a node with very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regstar.llm.shared import SharedTables


def connected_components(edges: DataFrame, shared: SharedTables) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b; any ordered type);
    component is the smallest node of the component. Self links and repeated
    links count once; a null end drops the link. No edges: no rows."""
    links = shared.put(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links0",
    )
    step = 0
    while not _is_stars(links):
        step += 1
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.where("b > a").join(_minima(both, shared, f"large_minima{step}"), "a")
        links2 = shared.put(
            large.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), f"large{step}"
        )
        small = links2.join(_minima(links2, shared, f"small_minima{step}"), "a")
        pairs = small.select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("p"))
        new = pairs.select(F.col("p.a").alias("a"), F.col("p.m").alias("b")).where("a <> b").distinct()
        new = shared.put(new, f"links{step}")
        for old in (f"links{step - 1}", f"large_minima{step}", f"large{step}", f"small_minima{step}"):
            shared.drop(old)
        links = new
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )


def _minima(links: DataFrame, shared: SharedTables, name: str) -> DataFrame:
    """Each node with the smallest of itself and its neighbours."""
    return shared.put(links.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), name)


def _is_stars(links: DataFrame) -> bool:
    """Every node has one link to a smaller node and is then no such node
    itself."""
    ends = links.select(F.col("a").alias("n"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
        links.select(F.col("b").alias("n"), F.lit(0).alias("down"), F.lit(1).alias("up"))
    )
    per_node = ends.groupBy("n").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return per_node.where("down > 1 OR (down = 1 AND up = 1)").isEmpty()
