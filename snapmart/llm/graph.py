"""Connected components by alternating stars."""

from pyspark.sql import DataFrame, functions as F

from snapmart.session import stage

ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """``_node, _root`` of every node of ``edges`` (_a, _b: numbers), the root being the least node of its component.

    Large stars hang a node's larger neighbours on the least of them, small stars its smaller ones, until nothing
    changes, which takes about as many rounds as the logarithm of the longest path. A node with very many neighbours is
    an aggregate and a join that Spark splits; no component comes together in a task. Should ``ROUNDS`` not do, that is an error.
    """
    now = stage(edges.where("_a <> _b").select(F.greatest("_a", "_b").alias("_a"), F.least("_a", "_b").alias("_b")).distinct())
    state = None
    for _ in range(ROUNDS):
        both = now.union(now.select("_b", "_a"))
        least = both.groupBy("_a").agg(F.least(F.min("_b"), F.col("_a")).alias("_m"))
        large = both.join(least, "_a").where("_b > _a").select(F.col("_b").alias("_a"), F.col("_m").alias("_b")).distinct()
        lower = large.groupBy("_a").agg(F.min("_b").alias("_m"))
        small = large.join(lower, "_a")
        small = small.where("_b <> _m").select(F.col("_b").alias("_a"), F.col("_m").alias("_b")).union(lower.select("_a", F.col("_m").alias("_b"))).distinct()
        now = stage(small.select(F.greatest("_a", "_b").alias("_a"), F.least("_a", "_b").alias("_b")))
        fresh = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("_a", "_b").cast("decimal(38,0)"))).first()
        if fresh == state:
            break
        state = fresh
    else:
        raise ArithmeticError(f"components did not converge in {ROUNDS} rounds")
    roots = now.select("_b").distinct()
    return now.select(F.col("_a").alias("_node"), F.col("_b").alias("_root")).union(roots.select("_b", "_b"))
