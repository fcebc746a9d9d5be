"""Connected components of links between long ids, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .shared import stored


def components(links: DataFrame) -> DataFrame:
    """``(id, component)`` for every id in ``links(a, b)``: the smallest id reachable.

    Alternates two steps until nothing changes. The large one points every larger
    neighbour of an id at the smallest neighbour, the small one every smaller neighbour.
    The stars that remain are the components. Neighbour lists are never gathered: the
    minimum is an aggregation, so a hub with very many links is no special case. Links of
    an id to itself and repeated links change nothing; no links give no rows.
    """
    edges = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links", small=True
    )
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.greatest("v", "m").alias("u"), F.col("m").alias("v"))
        small = small.where("u <> v").unionByName(down.select("u", F.col("m").alias("v"))).distinct()
        edges = stored(small, "links", small=True)
    ids = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return ids.unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
