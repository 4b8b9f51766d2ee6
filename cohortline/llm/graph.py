"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.plans.durable import freeze


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first())


def components(links: DataFrame) -> DataFrame:
    """``(u, root)`` for each end of a link ``(u, v)``: the smallest end in its component.

    Large-star and small-star steps alternate until the links stop changing, a
    logarithmic number of rounds in practice. Minima are partial aggregates; the
    join that hands them out is split by adaptive execution where a hub is hot.
    Every round is written out, so a lost executor costs one round.
    """
    ends = ["u", "v"]
    links = freeze(links.filter("u <> v").select(F.greatest(*ends).alias("u"), F.least(*ends).alias("v")).distinct())
    before = _state(links)
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Large star: every larger neighbour is tied to the smallest neighbour.
        large = freeze(
            both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v").distinct()
        )
        # Small star: every smaller neighbour, and the node, is tied to the smallest one.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        links = freeze(
            large.join(least, "u").select("v", "m").filter("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        after = _state(links)
        if after == before:
            break
        before = after
    return links.select("u", F.col("v").alias("root")).unionByName(
        links.select(F.col("v").alias("u"), F.col("v").alias("root")).distinct()
    )
