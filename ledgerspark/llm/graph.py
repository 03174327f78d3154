"""Connected components of a link table by alternating stars.

Every step is a grouped minimum and a join, so a component of any size is spread over all tasks. Each round is
written to the shared folder, which keeps the lineage short and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerspark.llm.tables import stage


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has a link; component is the smallest node that links reach.

    Links are undirected, may repeat and may be loops; rows with a null end are no links. An empty table gives
    an empty result.
    """
    edges = stage(
        links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
        "links",
    )
    before = _fingerprint(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.join(nearest, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(lowest, "u").where("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        edges = stage(small.unionByName(lowest.select("u", F.col("low").alias("v"))).distinct(), "links")
        after = _fingerprint(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
