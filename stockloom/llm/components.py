"""Connected components of a graph given as rows, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.llm.common import stored


def _smallest_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.min("b").alias("least"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (`node`, `component`) for every node that has a link; `component` is its smallest member.

    Rounds of large-star and small-star: a node links its larger (then its smaller) neighbours to the
    smallest one it knows, until every component is a star. The number of rounds grows with the logarithm of
    the nodes. Neighbours are never listed: a round is a minimum per node, which combines before the
    shuffle, and a join on the node, whose hot keys adaptive execution splits. Loops and repeated links are
    allowed; no links give no rows. Each round is written to the shared folder, so a lost executor repeats
    one round at most.
    """
    edges = stored(
        links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct(), "links"
    )
    before = None
    while True:
        # Large star: every larger neighbour of a node goes to the node's smallest neighbour (or itself).
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (
            both.join(_smallest_neighbour(both), "a")
            .filter("b > a")
            .select(F.col("b").alias("a"), F.least("a", "least").alias("b"))
            .distinct()
        )
        # Small star: a node and its smaller neighbours go to the smallest of them.
        small = large.join(_smallest_neighbour(large), "a")
        edges = stored(
            small.select(F.col("a"), F.col("least").alias("b"))
            .unionAll(small.filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b")))
            .distinct(),
            "links",
        )
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = state
