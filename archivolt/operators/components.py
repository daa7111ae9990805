"""Connected components of an edge table, without collecting it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archivolt.session import cut


def connected_components(vertices: DataFrame, edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component): component is the smallest id reachable. vertices has `id`, edges have `src`, `dst` of the same type.

    Large-star and small-star steps alternate: every edge is rewritten towards the smallest neighbour until nothing changes,
    which takes a number of rounds logarithmic in the longest path. Each round is checkpointed, so it survives lost executors.
    Null ends and loops are ignored; isolated vertices are their own component; repeated edges count once."""
    e = edges.select("src", "dst").where("src is not null and dst is not null and src <> dst")
    e = cut(e.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct())
    last = None
    for _ in range(rounds):
        # large star: each vertex and its neighbours; larger neighbours are linked to the smallest of all
        both = e.union(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        low = both.groupBy("src").agg(F.min("dst").alias("m"))
        large = both.join(low, "src").where(F.col("dst") > F.col("src")).select(F.col("dst").alias("src"), F.least("m", "src").alias("dst"))
        # small star: each vertex and its smaller neighbours; all are linked to the smallest
        small_low = large.groupBy("src").agg(F.min("dst").alias("m"))
        linked = large.join(small_low, "src")
        small = linked.where(F.col("dst") != F.col("m")).select(F.col("dst").alias("src"), F.col("m").alias("dst"))
        e = cut(small.union(small_low.select("src", F.col("m").alias("dst"))).distinct())
        state = e.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        if last == state:
            break
        last = state
    else:
        raise RuntimeError(f"no end after {rounds} rounds")
    label = e.groupBy("src").agg(F.min("dst").alias("component"))
    return vertices.select("id").distinct().join(label, F.col("id") == F.col("src"), "left").select("id", F.coalesce("component", "id").alias("component"))
