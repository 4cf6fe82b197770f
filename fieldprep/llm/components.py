"""Connected components of a graph held as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldprep.llm.store import cut


def _round(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step on links u > v."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    lowest = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
    return small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(u, v) with v the smallest vertex that u reaches, for every u that is not itself the smallest.

    ``links`` has two columns u and v of one comparable type, in either order, repeats allowed.
    Every round aggregates per vertex and joins back, so a vertex with very many links is spread by
    the join; rounds grow with the logarithm of the graph's diameter, and each is checkpointed.
    """
    links = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    links, before = cut(links.distinct()), None
    while True:
        now = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1048583)).first()
        if now == before or not now[0]:
            return links
        before, links = now, cut(_round(links))
