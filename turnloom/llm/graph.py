"""Connected components by alternating stars, as joins and aggregates with map-side combine.

Every round hangs each node's larger neighbours to its smallest one and then its smaller ones,
until all edges are stars around the smallest node. Rounds grow with the logarithm of the
longest path. Edges are written to the shared folder after each round. A hub, a node with more
than a HEAVY_SHARE of all edges, is joined by broadcast: there are few of them, and their edges
stay where they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnloom.llm.common import Work

HEAVY_SHARE = 0.001


def _heavy(counts: DataFrame) -> DataFrame:
    """The rows of counts (`n` rows each) that hold more than a HEAVY_SHARE of all rows.

    They are fewer than 1 / HEAVY_SHARE, so they may be broadcast.
    """
    rows = counts.agg(F.sum("n")).first()[0] or 0
    some = counts.filter(F.col("n") > rows * HEAVY_SHARE)
    return F.broadcast(counts.sparkSession.createDataFrame(some.collect(), counts.schema))


def _around(pairs: DataFrame, work: Work) -> DataFrame:
    """Pairs (u, v) of a written table with the smallest of u and all its partners as m."""
    smallest = pairs.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
    smallest = work.put(smallest.select("u", F.least("u", "m").alias("m"), "n"), "smallest")
    hubs = _heavy(smallest)
    hot = pairs.join(hubs, "u")
    return hot.unionByName(pairs.join(hubs, "u", "left_anti").join(smallest, "u"))


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], int(row["h"] or 0)


def components(edges: DataFrame, work: Work) -> DataFrame:
    """(node, root) for every node of an edge (a, b); root is the smallest node reachable."""
    larger = edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    now = work.put(larger.distinct(), "edges")
    state = _state(now)
    while True:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            now.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        large = _around(both, work).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        near = _around(work.put(large.distinct(), "pairs"), work)
        small = near.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            near.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
        now = work.put(small.filter("a <> b").distinct(), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    members = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return members.union(now.select("b", "b").distinct())


def skew_join(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Inner join with the heavy keys of the left side joined by broadcast.

    Both sides should be written tables, as they are read twice; keys are unique on the right and
    never NULL on the left.
    """
    keys = _heavy(left.groupBy(on).agg(F.count(F.lit(1)).alias("n"))).drop("n")
    known = right.join(F.broadcast(keys), on, "left_semi")
    hot = left.join(F.broadcast(known), on)
    return hot.unionByName(left.join(F.broadcast(keys), on, "left_anti").join(right, on))


def smallest_keys(nodes: DataFrame, roots: DataFrame, key: str, work: Work) -> DataFrame:
    """key, n_shingles and component_id, the smallest key of the component, of every row of nodes.

    A row whose node is NULL is its own component. Copies of one set and members of one component
    may be any share of the table: neither node nor root is joined without care for heavy keys.
    """
    own = nodes.filter("node IS NOT NULL").groupBy("node").agg(F.min(key).alias("own"))
    placed = work.put(own.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "placed")
    least = work.put(placed.groupBy("root").agg(F.min("own").alias("component_id")), "least")
    known = work.put(skew_join(placed, least, "root").select("node", "component_id"), "known")
    found = skew_join(nodes.filter("node IS NOT NULL"), known, "node")
    alone = nodes.filter("node IS NULL").select(key, "n_shingles", F.col(key).alias("component_id"))
    return found.select(key, "n_shingles", F.coalesce("component_id", key).alias("component_id")).unionByName(alone)
