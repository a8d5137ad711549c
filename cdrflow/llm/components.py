"""Connected components of a link table, in rounds of joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdrflow.llm.common import staged


def _digest(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v")
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(mixed).alias("x"), F.sum(F.pmod(mixed, F.lit(1_000_003))).alias("s")
    ).first()
    return row["n"], row["x"], row["s"]


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): each linked id with the smallest id it can reach.

    Alternating large-star and small-star rounds: every node points its
    neighbours to the smallest one until nothing changes (a number of rounds
    that grows with the logarithm of the input).  A round is aggregates with
    map-side minima and joins on the node; each is written, so the lineage
    stays one round long.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    edges = staged(edges, "links")
    seen = _digest(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.filter("u <> v").distinct(), "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = moved.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        small = small.unionByName(least.withColumnRenamed("m", "v")).distinct()
        edges = staged(small, "links")
        now = _digest(edges)
        if now == seen:
            break
        seen = now
    own = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(own)
