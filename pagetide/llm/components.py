"""Connected components over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pagetide.llm.common import join_counted
from pagetide.sources.tables import stored


def _smallest(links: DataFrame) -> DataFrame:
    """Per ``u`` the smallest of itself and its partners, and its number of links."""
    return links.groupBy("u").agg(
        F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n")
    )


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of ``links(u, v)``: the label is its smallest member.

    Alternates two steps until nothing changes. Large star: every larger partner of a node
    is linked to the node's smallest partner. Small star: every smaller partner of a node,
    and the node, likewise. Each step is one aggregate and one join; the rounds grow with
    the logarithm of the longest chain. A node with many links is cut into parts, and each
    round is written to the shared folder. The graph without links gives no rows.
    """
    links = stored(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while True:
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            return links.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
                links.select(F.col("v"), F.col("v")).distinct()
            )
        before, total = state, state[0]
        both = links.union(links.select("v", "u"))
        large = (
            join_counted(both, stored(_smallest(both)), ["u"], "n", 2 * total, F.col("v"))
            .filter("v > u and v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        large = stored(large)
        small = stored(_smallest(large))
        links = stored(
            join_counted(large, small, ["u"], "n", total, F.col("v"))
            .filter("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(small.select("u", "m"))
            .distinct()
        )
