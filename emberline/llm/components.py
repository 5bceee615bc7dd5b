"""Connected components of a distributed edge table, by large-star and small-star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .session import save


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (u, v of any ordered type); root is its component's least node.

    Each round is two joins on the edge table, which never grows; rounds grow with the logarithm of
    the components' diameters. Hubs are handled by aggregates with map-side combine and by joins,
    never gathered. Null ends are ignored; an empty table gives no rows.
    """
    plain = edges.where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
    stars = save(plain.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "stars")
    before = None
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Large star: each larger neighbour is linked to the least of the neighbourhood.
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where(F.col("u") != F.col("v")).distinct()
        # Small star: a node and its smaller neighbours are linked to the least of these.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = save(small.unionByName(least.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v")).distinct(), "stars")
        now = stars.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if now == before:
            break
        before = now
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
