"""Connected components of a distributed list of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Steps


def components(steps: Steps, links: DataFrame) -> DataFrame:
    """``node, component`` (the least node reachable) for every node with a link; ``links`` holds ``a, b``.

    Each round hangs every node's larger neighbours, then its smaller ones, under the least node around it.
    Rounds grow with the logarithm of the longest path; no neighbourhood is gathered in one place.
    """
    edges = steps.table(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        # Large star: larger neighbours of u move to the least node around u.
        large = steps.table(
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        # Small star: u and its smaller neighbours move to the least of them.
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(lowest.select("u", F.col("m").alias("v")))
            .distinct()
        )
        new = steps.table(small)
        steps.free(large)
        steps.free(edges)
        edges = new
        seen = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("u") % 1_000_003)).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
