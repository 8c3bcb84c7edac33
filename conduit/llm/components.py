"""Connected components of links, as rounds of star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conduit.session import cut_lineage


def _signature(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, most_rounds: int = 64) -> DataFrame:
    """``(node, root)`` for every node of ``links(u, v)``; root is the smallest node reachable.

    Large-star and small-star rounds: each moves links to the smallest neighbour
    known, until every node hangs on its root. Only minima are aggregated, so a hub is
    pre-aggregated before any exchange, and each round is cut by a written table.
    """
    edges = cut_lineage(
        links.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "links",
    )
    seen = _signature(edges)
    for _ in range(most_rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut_lineage(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "stars")
        now = _signature(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
