"""Connected components of a graph given as a table of links.

Alternating large-star and small-star steps: every node is linked to the smallest
node it knows of, first from above, then from below, until nothing changes.  Each
step is one map-side aggregation and one join, so a node with very many links is
spread over tasks.  Tables are written between rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.tables import stage
from encore.sources.staging import Workspace


def _star(links: DataFrame, upward: bool, work: Workspace) -> DataFrame:
    """Link each node's larger (or smaller) neighbours to its smallest neighbour."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not upward:
        both = both.where("b < a")
    least = stage(
        both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least", work
    )
    met = both.join(least, "a")
    if upward:
        linked = met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        linked = met.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))
        )
    return stage(linked.where("a <> b").distinct(), "links", work)


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, work: Workspace) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for all nodes with a link.

    ``links`` has two bigint columns ``a`` and ``b``.  Self-links, repeated links
    and an empty table are fine; a node without links is not in the result.
    """
    links = stage(links.where("a <> b").distinct(), "links", work)
    before = _state(links)
    while True:
        links = _star(_star(links, True, work), False, work)
        after = _state(links)
        if after == before:
            break
        before = after
    # now every node but the smallest is linked to the smallest, and to nothing else
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
