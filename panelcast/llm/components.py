"""Connected components of a link table by alternating large-star and small-star.

Both steps only use joins and ``min`` aggregates: a node with very many links
is pre-aggregated before the shuffle, and its links are spread by the skew
join. No group is collected anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.session import cut_lineage


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """Label every linked node with the smallest node that it reaches.

    ``links`` has long columns ``a`` and ``b`` in any direction; loops,
    repeats and nulls are ignored. Returns ``(node, root)`` for nodes other
    than roots; a node that is absent is its own root. An empty table gives
    an empty table. Each round is checkpointed to the shared folder.
    """
    links = cut_lineage(
        links.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = F.expr("count(*) as n"), F.expr("bit_xor(xxhash64(a, b)) as h")
    seen = links.agg(*mark).first()
    while seen["n"]:
        links = cut_lineage(_small_star(_large_star(links)))
        now = links.agg(*mark).first()
        if now == seen:
            break
        seen = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
