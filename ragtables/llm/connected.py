"""Connected components of a table of links, on Spark alone.

Large stars and small stars in turn: every node is tied to the least node among its
neighbours until each component is one star. Least neighbours come from a grouped
minimum, which is combined before the shuffle, and are joined back, by broadcast
while they are few, else as a join whose hot keys Spark splits. Each round is written to the
shared folder; the driver sees only a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragtables.llm.base import sent
from ragtables.sources.storage import materialize


def _tied(edges: DataFrame, larger: bool) -> DataFrame:
    """One star step over edges ``a > b``. A large star looks at them both ways."""
    back = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    seen = edges.union(back) if larger else edges
    least = seen.groupBy("a").agg(F.min("b").alias("m"))
    least = sent(materialize(least.select("a", F.least("a", "m").alias("m"))))
    if larger:
        # Larger neighbours of a node go to its least one.
        out = back.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = moved.union(least.select("a", F.col("m").alias("b"))).distinct()
    return out.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    )


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root``: every node of a link with the least node that it reaches.

    Nulls and links of a node to itself are left out. Links may repeat and stand in
    either direction. No links give no rows.
    """
    edges = materialize(
        links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .filter(F.col("a") != F.col("b"))
        .distinct()
    )
    state = _state(edges)
    while state[0]:
        edges = materialize(_tied(materialize(_tied(edges, larger=True)), larger=False))
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
