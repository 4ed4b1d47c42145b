"""Connected components of a large graph given as edges between string or number keys.

Large-star / small-star: every round is two grouped passes that hand each node's neighbours the smallest one they know. A hot node is no
hot group: a round only takes minima (partly aggregated before the shuffle) and joins, never the list of a node's neighbours. Each round
is written to the shared folder. The result is exact when a round changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolegauge.storage import materialize, remove


def starred(edges: DataFrame, small: bool) -> DataFrame:
    """One pass. Small star: each node's smaller neighbours are tied to its smallest; large star: its larger ones are."""
    both = edges.union(edges.select("b", "a")) if not small else edges
    near = both.groupBy("a").agg(F.min("b").alias("least"))
    near = near.select("a", F.least("a", "least").alias("least"))
    tied = both.join(near, "a")
    if small:
        pairs = tied.select(F.col("b").alias("a"), F.col("least").alias("b")).union(near.select("a", F.col("least").alias("b")))
    else:
        pairs = tied.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return pairs.where("a > b").distinct()


def components(edges: DataFrame, a: str, b: str, rounds: int = 60) -> DataFrame:
    """(node, component): the smallest key of its component, for every node that has an edge. Nulls and loops are left out."""
    pair = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"), F.col(a).alias("x"), F.col(b).alias("y"))
    now = materialize(pair.where("x is not null and y is not null and a > b").select("a", "b").distinct(), "edges")
    mark = signature(now)
    for _ in range(rounds):
        large = materialize(starred(now, small=False), "edges")
        after = materialize(starred(large, small=True), "edges")
        remove(large)
        remove(now)
        now, before, mark = after, mark, signature(after)
        if mark == before:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = now.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def signature(edges: DataFrame) -> tuple:
    """Two numbers that change when the set of edges changes."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
