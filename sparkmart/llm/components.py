"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import broadcast_checked, sized, stored


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64(F.lit(1), "u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """(id, comp) of every id in ``links`` (u, v): the smallest id it is connected with.

    Each round links every node to the smallest neighbour it or its
    neighbours know; minima are plain grouped aggregates, so a node with very
    many links never gathers them.  The minima are joined back as a broadcast
    while their counted size allows it.
    """
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    edges = stored(edges, "links")
    seen = _fingerprint(edges)
    while True:
        rows = 2 * seen[0]  # at most two minima per link
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        least = broadcast_checked(sized(least, rows), 24, rows=rows)
        large = both.join(least, F.col("u") == F.col("k")).where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        lowest = sized(large.groupBy("u").agg(F.min("v").alias("m")), rows)
        low = broadcast_checked(lowest.select(F.col("u").alias("k"), "m"), 24, rows=rows)
        small = large.join(low, F.col("u") == F.col("k")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(sized(small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct(), rows), "links")
        now = _fingerprint(edges)
        if now == seen:
            break
        seen = now
    roots = sized(edges.select(F.col("v").alias("id")).distinct(), seen[0]).select("id", F.col("id").alias("comp"))
    return stored(edges.select(F.col("u").alias("id"), F.col("v").alias("comp")).unionByName(roots), "components")
