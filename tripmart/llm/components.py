"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.session import cut_lineage, cut_observed

#: A key with more than this share of the rows, and more than this many, is hot.
HOT_SHARE = 0.002
LEAST_HOT = 256


def join_counted(rows: DataFrame, per_key: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` (``total`` of them) with the one row that ``per_key`` has for each
    key; its column n counts the rows of the key. Rows of hot keys stay where
    they are and get theirs by broadcast: there are fewer than 1 / HOT_SHARE
    such keys. The others meet in a shuffle."""
    hot = F.col("n") > F.lit(max(LEAST_HOT, int(total * HOT_SHARE)))
    some = per_key.filter(hot)
    others = rows.join(F.broadcast(some.select(key)), key, "left_anti")
    return rows.join(F.broadcast(some), key).unionByName(
        others.join(per_key.filter(~hot), key))


def _least_neighbour(pairs: DataFrame, total: int) -> DataFrame:
    """(u, v, m): m is the smallest of u and all its v."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
    return join_counted(pairs, least, "u", total).withColumn("m", F.least("u", "m"))


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of ``edges`` (a, b); the component is the
    smallest id in it. Each round writes its edges; a hot node is one partial
    minimum per task, and its edges don't move to meet it."""
    every = edges.select("a", "b")
    nodes = cut_lineage(every.select(F.col("a").alias("id")).union(
        every.select(F.col("b").alias("id"))).distinct(), "component_nodes")
    state = [F.count(F.lit(1)).alias("n"),
             F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")]
    now, seen = cut_observed(every.filter("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "stars", state)
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_least_neighbour(both, 2 * seen["n"]).filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        large, size = cut_observed(large.filter("u <> v").distinct(), "stars", state[:1])
        found = _least_neighbour(large, size["n"])
        small = found.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            found.select("u", F.col("m").alias("v")))
        before = seen
        now, seen = cut_observed(small.filter("u <> v").distinct(), "stars", state)
        if seen == before:
            break
    stars = now.groupBy("u").agg(F.min("v").alias("v"))
    return nodes.join(stars, nodes["id"] == stars["u"], "left").select(
        "id", F.coalesce("v", "id").alias("component"))
