"""Connected components of a table of links."""

from pyspark.sql import functions as F

from seispark.session import materialise


def components(links):
    """(node, root) for every node of ``links`` (a, b); root is the smallest node reachable.

    Large-star and small-star steps in turn: each node is linked to the least node it knows.
    Minima are pre-aggregated and joined back, so a node with any number of links makes no
    group; every round is a written table. An empty table of links gives no rows; a link of a node to itself is none.
    """
    edges = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = materialise(edges, "links"), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # a written table, so that the join with a node of very many links is between two exchanges and can be split
        least = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialise(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialise(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
