"""Connected components by alternating star contraction, all in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize

#: Beyond so many edges, aggregates that are joined again on their key are written first: then the join has an exchange of
#: its own on either side, and adaptive execution can split a hub's edges. Below, no node can have more edges than that.
HUB_EDGES = 1 << 20


def _signature(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(r)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected ``edges`` (a, b), root being the component's smallest node.

    Each round links the larger neighbours of a node to its smallest neighbour, then the smaller ones; rounds
    grow with the logarithm of the largest component. Every round is written to the shared folder. Edges with a
    null end are no links, self-loops and repeated edges change nothing, no edges give no rows.
    """
    known = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _signature(known)

    def apart(df: DataFrame, name: str) -> DataFrame:
        return materialize(df, name) if before[0] > HUB_EDGES else df

    while before[0]:
        both = known.unionByName(known.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        least = apart(least, "least")
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = apart(large, "large")
        down = apart(large.groupBy("a").agg(F.min("b").alias("m")), "down")
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(down.select("a", F.col("m").alias("b")))
        last, known = known, materialize(small.filter("a <> b").distinct(), "edges")
        discard(last, *(x for x in (least, large, down) if hasattr(x, "docloom_path")))
        after = _signature(known)
        if after == before:
            break
        before = after
    return known.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root").unionByName(known.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
