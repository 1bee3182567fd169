"""Connected components of a table of links.

Union-find inside each partition first leaves a forest; rounds of star
contraction (every node points to the smallest neighbour it knows) then merge
the forests of different partitions. Each round is written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import ship
from contrail.session import discard, settle


def components(links: DataFrame) -> DataFrame:
    """`node`, `component` (smallest node reachable) for all nodes of the links `a`, `b`.

    Links with a NULL end and links of a node to itself are ignored; repeated
    links count once; no links give no rows. Eager: the rounds run when called.
    """
    ship(links.sparkSession)
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    edges, seen = settle(links.mapInPandas(_forest, "a long, b long"), "forest"), None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        merged = settle(small.select("e.a", "e.b").where("a > b").distinct(), "stars")
        discard(edges)
        edges = merged
        state = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if state == seen:
            break
        seen = state
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.toDF("node", "component").unionByName(roots.select("node", F.col("node").alias("component")))


def _forest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each node of the partition's links with the smallest node of its tree."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    for frame in frames:
        for a, b in zip(frame["a"].tolist(), frame["b"].tolist(), strict=True):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    nodes = [x for x in parent if root(x) != x]
    for at in range(0, len(nodes), 100_000):
        part = nodes[at : at + 100_000]
        yield pd.DataFrame({"a": part, "b": [root(x) for x in part]}, dtype="int64")
