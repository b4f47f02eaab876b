"""Connected components by star contraction: edges are hung under ever smaller neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duewise.session import staged

MOST_ROUNDS = 60


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b); root is the smallest node reachable.

    Each round hangs the larger neighbours of a node under its smallest one, then the smaller ones,
    and is written to the shared folder. Rounds grow with the logarithm of the longest path. A node
    with very many links is only ever grouped by sums that are made ahead of the shuffle, and joined
    where Spark splits skewed keys. No edge leads to an empty result.
    """
    links = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    for _ in range(MOST_ROUNDS):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = staged(large, "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        # Where a node has one smaller neighbour, its link stays; other neighbours go under the least.
        links = staged(
            small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
            .unionByName(least.select("a", F.col("m").alias("b")))
            .distinct(),
            "links",
        )
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    # Settled: every remaining link leads from a node to its root.
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
