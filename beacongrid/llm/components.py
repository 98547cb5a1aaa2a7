"""Connected components of an edge table: union-find within partitions, then alternating large and small stars.

Nothing is collected: an iteration is two joins on node ids, and lineage is cut at every turn in the shared folder. What union-find
within partitions leaves of at most ONE_TASK edges (4 MB) is finished by union-find in one task, with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import checkpointed


ONE_TASK = 1 << 18


def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Union-find over all edges of a task: (node, label) rows."""
    every = [*batches, pd.DataFrame({"u": [], "v": []}, dtype="int64")]
    up = pd.concat(list(forest(iter([pd.concat(every)]))))
    nodes = {**{v: v for v in up["v"].tolist()}, **dict(zip(up["u"].tolist(), up["v"].tolist(), strict=True))}
    yield pd.DataFrame(list(nodes.items()), columns=["node", "label"]).astype("int64")


def forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Union-find over a partition's edges: each batch of them becomes (node, smallest node reached) rows."""
    for pdf in batches:
        parent: dict[int, int] = {}

        def find(x: int, parent: dict[int, int] = parent) -> int:
            while (p := parent.setdefault(x, x)) != x:
                parent[x] = x = parent[p]
            return x

        for a, b in zip(pdf["u"].tolist(), pdf["v"].tolist(), strict=True):
            ra, rb = find(a), find(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
        rows = [(x, r) for x in list(parent) if (r := find(x)) != x]
        yield pd.DataFrame(rows, columns=["u", "v"]).astype("int64")


def components(edges: DataFrame, a: str, b: str, most_rounds: int = 60) -> DataFrame:
    """(node, label) for every node of an edge between two different nodes; label is the smallest node of its component.

    Null ends, loops and repeated edges count as absent. No edge, no rows.
    """
    e = edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).where("u > v")
    e = checkpointed(e.mapInPandas(forest, "u long, v long").distinct())
    if e.count() <= ONE_TASK:
        return e.coalesce(1).mapInPandas(whole, "node long, label long")
    seen = None
    for _ in range(most_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.where("m < u").select("u", F.col("m").alias("v"))
        ).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))
        ).distinct()
        e = checkpointed(small)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
            )
        seen = now
    raise RuntimeError(f"no fixed point in {most_rounds} rounds")
