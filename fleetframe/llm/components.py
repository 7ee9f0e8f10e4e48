"""Connected components of an edge table by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleetframe.llm.common import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of ``edges`` (columns a, b; long); the root is
    the smallest node of the component.

    Each round hangs every neighbour above a node, then every neighbour below it,
    on the smallest node around; rounds repeat until the edge table stays the same
    (a number of rounds logarithmic in the size of a component).  Every round is
    written to the shared folder, so lineage stays short.  An empty table gives none.
    """
    def ordered(df):
        return df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()

    def signature(df):
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    now = materialize(ordered(edges), "components")
    before = signature(now)
    while before[0]:
        both = now.select("a", "b").unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # aggregates are written before the joins: a join of two plain shuffles can split a node with many edges
        least = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")),
                            "components")
        large = materialize(ordered(both.join(least, "a").where("b > a")
                                    .select(F.col("b").alias("a"), F.col("m").alias("b"))), "components")
        below = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "components")
        small = large.join(below, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = materialize(ordered(small.unionAll(below.select("a", F.col("m").alias("b")))), "components")
        after = signature(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")) \
        .unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
