"""Connected components by alternating large-star and small-star steps over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.tables import save


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, label): for each node of an edge, the smallest node that it reaches.

    A step needs only each node's smallest neighbour (a partial aggregate, so a hub is a row a task), never a list of
    neighbours. Rounds end when a round changes no edge; paths take a logarithmic number of them. Null ends are left out.
    """
    e = save(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct())
    before = None
    for _ in range(most_rounds):
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select("u", F.col("m").alias("v")).unionByName(joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        e = save(small)
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return nodes.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("label"))).groupBy("node").agg(F.min("label").alias("label"))
