"""Approximate nearest neighbours: partitions of a neighbour graph, learned by a classifier that routes rows and queries."""

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from snapmart.llm.common import written

#: Vectors that the partitions and the router are fitted on at most, those with the smallest hashes of their ids.
SAMPLE = 8192
GRAPH = 10
#: Rows that a partition should hold, and partitions at most (the sample must tell what is in each).
PART_ROWS = 4000
MOST_PARTS = 128
#: Recall on held-out vectors of the sample that sets how many partitions a query visits.
WANTED = 0.95
HIDDEN = 96
EPOCHS = 40
#: Rows, and queries, that meet in one task.
BLOCK = 4096


class Router(NamedTuple):
    """A network of one hidden layer; its outputs are log-odds of partitions."""

    center: np.ndarray
    scale: float
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(((x - self.center) * self.scale) @ self.first + self.first_bias, 0) @ self.second + self.second_bias


def neighbour_graph(x: np.ndarray, k: int = GRAPH) -> np.ndarray:
    """The ``k`` other rows with the largest inner products, for each row."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), int)
    for lo in range(0, len(x), 1024):
        near = x[lo:lo + 1024] @ x.T
        near[np.arange(len(near)), np.arange(lo, lo + len(near))] = -np.inf
        out[lo:lo + 1024] = np.argpartition(-near, k - 1, axis=1)[:, :k] if k else 0
    return out


def bisect(nodes: np.ndarray, a: np.ndarray, b: np.ndarray, size: int, rng: np.random.Generator) -> np.ndarray:
    """Which half each of ``nodes`` goes to: even halves that few edges (a, b) join.

    The second eigenvector of the edges' random walk, cut at its median; then pairs of nodes whose neighbours are on the other
    side are exchanged while that cuts fewer edges.
    """
    place = np.full(size, -1)
    place[nodes] = np.arange(len(nodes))
    inside = (place[a] >= 0) & (place[b] >= 0)
    a, b = place[a[inside]], place[b[inside]]
    n = len(nodes)
    degree = np.bincount(a, minlength=n) + 1.0
    v = rng.standard_normal(n)
    for _ in range(60):
        v = (np.bincount(a, v[b], n) + v) / degree
        v -= (v * degree).sum() / degree.sum()
        v /= np.abs(v).max() + 1e-30
    side = np.zeros(n, int)
    side[np.argsort(v, kind="stable")[n // 2:]] = 1
    for _ in range(10):
        ones = np.bincount(a, side[b], n)
        gain = np.where(side == 1, degree - 1 - 2 * ones, 2 * ones - degree + 1)
        up, down = (np.flatnonzero((side == s) & (gain > 0)) for s in (0, 1))
        swaps = min(len(up), len(down)) // 2
        if not swaps:
            break
        for group in (up, down):
            chosen = group[np.argsort(-gain[group], kind="stable")[:swaps]]
            side[chosen] = 1 - side[chosen]
    return side


def partition(graph: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """Even parts (a power of two) of a graph, halved again and again."""
    n = len(graph)
    near, far = np.repeat(np.arange(n), graph.shape[1]), graph.ravel()
    a, b = np.concatenate([near, far]), np.concatenate([far, near])
    part = np.zeros(n, int)
    for _ in range(int(math.log2(parts))):
        halves = part * 2
        for p in range(part.max() + 1):
            nodes = np.flatnonzero(part == p)
            halves[nodes] += bisect(nodes, a, b, n, rng)
        part = halves
    return part


def train(x: np.ndarray, goals: np.ndarray, rng: np.random.Generator) -> Router:
    """A router whose outputs fit ``goals``, the shares of each row's neighbours in the partitions."""
    center, parts = x.mean(axis=0), goals.shape[1]
    scale = 1 / max(float((x - center).std()), 1e-12)
    z = (x - center) * scale
    w = [rng.standard_normal((x.shape[1], HIDDEN)) * math.sqrt(2 / x.shape[1]), np.zeros(HIDDEN), rng.standard_normal((HIDDEN, parts)) * 0.1, np.zeros(parts)]
    m, v = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
    step = 0
    for epoch in range(EPOCHS):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // 128)):
            step += 1
            hidden = np.maximum(z[rows] @ w[0] + w[1], 0)
            out = hidden @ w[2] + w[3]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            error = (out / out.sum(axis=1, keepdims=True) - goals[rows]) / len(rows)
            back = (error @ w[2].T) * (hidden > 0)
            rate = 0.003 * (1 - 0.9 * epoch / EPOCHS)
            for k, g in enumerate([z[rows].T @ back, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]):
                m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                w[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return Router(center, scale, *w)


def fit(x: np.ndarray, rows: int, k: int) -> tuple[Router, int]:
    """The router for a table of ``rows`` rows, and how many partitions a query has to visit.

    A fifth of the sample is kept out of the training; its ``k`` nearest in the whole sample tell the visits needed.
    """
    rng = np.random.default_rng(11)
    parts = 2 ** max(0, math.ceil(math.log2(max(1, min(MOST_PARTS, rows / PART_ROWS, len(x) / 32)))))
    if parts == 1:
        d = x.shape[1]
        return Router(np.zeros(d), 1.0, np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)), 1
    held = np.arange(len(x)) % 5 == 0
    learn = x[~held]
    graph = neighbour_graph(learn)
    part = partition(graph, parts, rng)
    goals = np.zeros((len(learn), parts))
    np.add.at(goals, (np.arange(len(learn)), part), 2.0)
    np.add.at(goals, (np.repeat(np.arange(len(learn)), graph.shape[1]), part[graph.ravel()]), 1.0)
    router = train(learn, goals / goals.sum(axis=1, keepdims=True), rng)
    scores = router.scores(x)
    home = scores.argmax(axis=1)
    near = neighbour_graph(np.vstack([x[held], x[~held]]), k)[: held.sum()]
    homes = np.concatenate([home[held], home[~held]])[near]
    ranks = np.empty_like(scores[held], dtype=int)
    np.put_along_axis(ranks, np.argsort(-scores[held], axis=1, kind="stable"), np.arange(parts)[None, :], axis=1)
    needed = np.sort(np.take_along_axis(ranks, homes, axis=1).ravel())
    return router, int(needed[min(len(needed) - 1, math.ceil(WANTED * len(needed)))]) + 1


def _top(queries: tuple, rows: tuple, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of each query's ``k`` best rows. A product of matrices finds them, a sum in the order of components scores them."""
    (qid, q), (rid, r) = queries, rows
    rough = q @ r.T
    rough[qid[:, None] == rid[None, :]] = -np.inf
    if len(rid) > k:
        least = -np.partition(-rough, k - 1, axis=1)[:, k - 1]
        i, j = np.nonzero(rough >= (least - 1e-9 * (1 + np.abs(least)))[:, None])
    else:
        i, j = np.nonzero(np.ones_like(rough, bool))
    keep = qid[i] != rid[j]
    i, j = i[keep], j[keep]
    score = np.zeros(len(i))
    for d in range(q.shape[1]):
        score += q[i, d] * r[j, d]
    order = np.lexsort((rid[j], -score, i))
    i, j, score = i[order], j[order], score[order]
    rank = np.arange(len(i)) - np.searchsorted(i, i)
    keep = rank < k
    return qid[i[keep]], rid[j[keep]], score[keep]


def usable(vector: Column) -> Column:
    """Neither null nor zero, and all components are numbers."""
    odd = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    return vector.isNotNull() & F.exists(vector, lambda v: v != 0) & ~F.exists(vector, odd)


def search(vectors: DataFrame, is_query: Column, k: int = 20, id_column="vec_id", vector_column="embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows with the largest inner products found for each query row.

    Fitted on a bounded sample, the router puts every row into its most probable partition and sends each query to its several
    most probable ones, further ones while those hold too few rows; there the rows are ranked exactly. Rows and queries of a partition meet in
    blocks of bounded size. Of equal vectors only the ``k + 1`` with the least ids can be among the nearest, so only those are
    candidates, which keeps a very common vector from filling a partition; all of them remain queries.

    Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows without an id or of another length
    than most; ties go to the smaller id; rows that repeat an id are one candidate, and never their own; an empty
    table gives an empty result; other columns are left out.
    """
    spark = vectors.sparkSession
    clean = (vectors.select(F.col(id_column).cast("long").alias("_id"), F.col(vector_column).cast("array<double>").alias("_v"), F.coalesce(is_query, F.lit(False)).alias("_q"))
             .where(usable(F.col("_v")) & F.col("_id").isNotNull()))
    most = clean.groupBy(F.size("_v").alias("_d")).count().orderBy(F.desc("count"), "_d").first()
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    if most is None:
        return empty
    clean = clean.where(F.size("_v") == most["_d"])
    sample = clean.orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE).select("_v").collect()
    router, visits = fit(np.array([r["_v"] for r in sample]), most["count"], k)

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            if not len(flat):
                continue
            x = flat.reshape(batch.num_rows, -1)
            order = np.argsort(-router.scores(x), axis=1, kind="stable").astype(np.int32)
            parts = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * order.shape[1]), pa.array(order.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, parts], ["_id", "_v", "_q", "_parts"])

    placed = written(clean.mapInArrow(routed, "_id bigint, _v array<double>, _q boolean, _parts array<int>"), "neighbour-index")
    alike = Window.partitionBy("_v").orderBy("_id")
    # Repeats of an id go before the cut, or they would use up places of other ids.
    rows = (placed.select("_id", "_v", F.get("_parts", F.lit(0)).alias("_part")).dropDuplicates(["_id"])
            .withColumn("_n", F.row_number().over(alike)).where(F.col("_n") <= k + 1).drop("_n"))
    rows = written(rows, "neighbour-rows")
    counts = {r["_part"]: r["count"] for r in rows.groupBy("_part").count().collect()}  # a row for each partition
    sizes = F.array(*[F.lit(counts.get(p, 0)) for p in range(max(counts) + 1)])
    held = F.aggregate(F.slice("_parts", 1, visits), F.lit(0).cast("long"), lambda n, p: n + F.coalesce(F.get(sizes, p), F.lit(0)))
    # Partitions in order of probability: so many as planned, and more while they hold too few rows.
    enough = F.aggregate("_parts", F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("rows")),
                         lambda a, p: F.when((a["n"] >= visits) & (a["rows"] > k), a).otherwise(
                             F.struct((a["n"] + 1).alias("n"), (a["rows"] + F.coalesce(F.get(sizes, p), F.lit(0))).alias("rows"))))["n"]
    visited = F.when(held > k, F.lit(visits)).otherwise(enough)
    asked = placed.where("_q").dropDuplicates(["_id"]).select("_id", "_v", F.explode(F.slice("_parts", F.lit(1), visited)).alias("_part"))
    asked_counts = {r["_part"]: r["count"] for r in asked.groupBy("_part").count().collect()}

    def blocks(of: dict) -> Column:
        return F.greatest(F.lit(1), F.coalesce(F.get(F.array(*[F.lit(-(-of.get(p, 0) // BLOCK)) for p in range(max([*of, 0]) + 1)]), F.col("_part")), F.lit(1))).cast("int")

    own = lambda n, seed: F.pmod(F.xxhash64("_id", F.lit(seed)), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = asked.withColumn("_j", own(blocks(asked_counts), 1)).withColumn("_i", every(blocks(counts)))
    right = rows.withColumn("_i", own(blocks(counts), 2)).withColumn("_j", every(blocks(asked_counts)))

    def rank(queries: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or found.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        q, r = ((d["_id"].to_numpy(np.int64), np.stack(d["_v"].to_numpy())) for d in (queries, found))
        got = [_top((q[0][lo:lo + 512], q[1][lo:lo + 512]), r, k) for lo in range(0, len(q[0]), 512)]
        return pd.DataFrame({name: np.concatenate([g[n] for g in got]) for n, name in enumerate(("query_id", "vec_id", "score"))})

    near = left.groupBy("_part", "_i", "_j").cogroup(right.groupBy("_part", "_i", "_j")).applyInPandas(rank, "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
