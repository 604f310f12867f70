"""Connected components of a link table by alternating star contraction, in DataFrame steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a vertex now points at the least of the vertex and its neighbours."""
    both = _both_ways(links)
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(links: DataFrame) -> DataFrame:
    """A vertex and its smaller neighbours now point at the least of these neighbours. ``links`` have u > v."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """id, component: the least id reachable, for every id that has a link. Ids are longs; links to itself and nulls go.

    Steps alternate until only stars are left (about the logarithm of the longest chain); each is written to the shared
    folder.
    A vertex with very many links is one small row of a pre-aggregated minimum; its join is split by adaptive execution.
    """
    stars = cut_lineage(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), (F.col(a).isNotNull() & F.col(b).isNotNull()).alias("both"))
        .where("both AND u <> v").select("u", "v"),
        "links",
    )
    while True:
        stars = cut_lineage(_small_star(_large_star(stars)), "stars")
        inner = stars.join(stars.select(F.col("u").alias("v")), "v", "left_semi")
        if inner.isEmpty():  # no vertex that is pointed at points on: every link leads to its root
            roots = stars.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
            return stars.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)
