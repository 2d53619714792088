"""Connected components of a graph of links, by least labels and shortcuts, without gathering the graph anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import written


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) of each node of edges(a, b: long); root: the least node of its component.

    Each round replaces edges by the star of each larger neighbour to the least one, then of each smaller neighbour
    (large-star, small-star); the edges of a component of n nodes become its star in about log(n) rounds. A round's
    edges are written to the shared folder, so a lost executor costs a round's tasks at most. A star's hot centre is
    summed in part before the shuffle, and its join is one that adaptive execution splits.
    """
    e = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    for _ in range(most_rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Written, so that both sides of the join come from exchanges of their own and a hot centre's rows can be split.
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m")), "least")
        large = both.join(least, both.u == least.k).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        down = down.withColumnRenamed("u", "k")
        small = large.join(down, large.u == down.k).select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
        new = written(small.select("x.u", "x.v").where("u <> v").distinct(), "edges")
        if _same(e, new):
            break
        e = new
    else:
        raise RuntimeError(f"no fixpoint after {most_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _same(a: DataFrame, b: DataFrame) -> bool:
    sums = [x.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first() for x in (a, b)]
    return sums[0] == sums[1]
