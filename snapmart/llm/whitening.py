"""Embedding whitening: leading eigenpairs of the covariance by contour integration (FEAST), counted by inertia."""

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from snapmart.llm.common import written

#: What a component c of a vector becomes: floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: What stands for larger products with SCALE, which a long might not hold.
LARGEST = 2.0**60
#: Quadrature nodes on the upper half of a contour.
NODES = 8
#: Eigenvalues that an interval should hold, and shifts that are counted at once.
WANTED, SHIFTS = 8, 64
#: Rounds that borders are looked for in at most.
ROUNDS = 8
#: Eigenvalues below this share of the largest are no components: double precision can't tell them from none.
LEAST = 1e-10


class Fit(NamedTuple):
    """Rows fitted on, sums by dimension, the whole number that each dimension is centred at, what is left of its mean, eigenvalues, eigenvectors (columns), trace."""

    n: int
    sums: list
    center: np.ndarray
    rest: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def whole_vectors(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``_id, _x``: the x-vectors of rows with a vector of finite components only."""
    odd = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    clean = vectors.select(F.col(id_column).alias("_id"), F.col(vector_column).cast("array<double>").alias("_v")).where((F.size("_v") > 0) & ~F.exists("_v", odd))
    return clean.select("_id", F.transform("_v", lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(LARGEST)), F.lit(-LARGEST))).cast("long") + SHIFT).alias("_x"))


def _block(batch: pa.RecordBatch) -> np.ndarray:
    """The batch's vectors as rows; they are the last column."""
    column = batch.column(batch.num_columns - 1)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def inertia(a: np.ndarray) -> tuple[int, int]:
    """How many eigenvalues of a symmetric matrix are positive, and negative: by a factorisation with diagonal pivots of order 1 and 2."""
    a, up, down = a.copy(), 0, 0
    bound = (1 + math.sqrt(17)) / 8
    while len(a):
        diagonal = np.abs(np.diag(a))
        one = int(diagonal.argmax())
        off = np.abs(a)
        np.fill_diagonal(off, 0)
        i, j = divmod(int(off.argmax()), len(a))
        if max(diagonal[one], off[i, j]) == 0:
            break
        pivots = [one] if diagonal[one] >= bound * off[i, j] else [i, j]
        rest = np.setdiff1d(np.arange(len(a)), pivots)
        pivot, cross = a[np.ix_(pivots, pivots)], a[np.ix_(rest, pivots)]
        if len(pivots) == 1:
            up, down = up + int(pivot[0, 0] > 0), down + int(pivot[0, 0] < 0)
        else:
            up, down = up + 1, down + 1
        a = a[np.ix_(rest, rest)] - cross @ np.linalg.solve(pivot, cross.T)
        a = (a + a.T) / 2
    return up, down


def feast(v: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs of ``v`` with eigenvalues between ``low`` and ``high``.

    A quadrature over the circle through both of complex shifted solves projects a subspace onto their eigenvectors, and a Rayleigh-Ritz
    step on it gives the pairs, again and again until the residuals are those of rounding. ``count`` is the inertia's: a subspace
    that yields another number of pairs is enlarged, at last to the whole space.
    """
    d, size = len(v), np.linalg.norm(v)
    center, radius = (low + high) / 2, (high - low) / 2
    points, weights = np.polynomial.legendre.leggauss(NODES)
    angles = np.pi * (1 - points) / 2
    shifts = center + radius * np.exp(1j * angles)
    width = min(d, count + count // 2 + 4)
    while True:
        q = np.linalg.qr(np.random.default_rng(12).standard_normal((d, width)))[0]
        before = math.inf
        for _ in range(40):
            projected = np.zeros_like(q)
            for z, angle, w in zip(shifts, angles, weights, strict=True):
                projected += w / 2 * (radius * np.exp(1j * angle) * np.linalg.solve(z * np.eye(d) - v, q)).real
            q = np.linalg.qr(projected)[0]
            values, ritz = np.linalg.eigh(q.T @ v @ q)
            q = q @ ritz
            inside = np.flatnonzero((values > low) & (values < high))
            error = np.linalg.norm(v @ q[:, inside] - q[:, inside] * values[inside], axis=0).max(initial=0)
            if len(inside) == count and (error <= 1e-14 * size or before <= 1e-12 * size and error >= before / 2):
                return values[inside][::-1], q[:, inside][:, ::-1]
            before = error if len(inside) == count else math.inf
        if width == d:
            raise ArithmeticError(f"{count} eigenvalues between {low} and {high} were not found")
        width = min(d, 2 * width)


def counts_above(spark: SparkSession, shared, shifts: list[float]) -> list[int]:
    """How many eigenvalues of the broadcast matrix are larger than each shift; a task for each shift."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            above = [inertia(shared.value - s * np.eye(len(shared.value)))[0] for s in batch["shift"]]
            yield pd.DataFrame({"no": batch["no"], "above": above})

    made = spark.createDataFrame(list(enumerate(map(float, shifts))), "no long, shift double").repartition(max(1, len(shifts)))
    return [r["above"] for r in sorted(made.mapInPandas(run, "no long, above long").collect())]


def intervals(spark: SparkSession, shared, most: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues) of disjoint intervals that hold the ``most`` largest eigenvalues together, the highest first.

    Shifts are counted in rounds, each of which refines the brackets that hold several of the wanted eigenvalues. Borders are the middles of
    empty brackets only, so an eigenvalue is never close to one on the scale of its interval.
    """
    v = shared.value
    top = float(np.abs(v).sum(axis=1).max()) * (1 + 1e-9)
    at = {-top * 1e-6: len(v), top: 0}
    ask = list(np.linspace(0, top, SHIFTS + 2)[1:-1])
    for _ in range(ROUNDS):
        at |= zip(ask, counts_above(spark, shared, ask), strict=True)
        edges = sorted(at, reverse=True)
        many = [(hi, lo) for hi, lo in zip(edges, edges[1:], strict=False) if at[lo] - at[hi] > 1 and at[hi] < most and hi - lo > 1e-12 * top]
        if not many:
            break
        each = max(1, SHIFTS // len(many))
        ask = [x for hi, lo in many for x in np.linspace(lo, hi, each + 2)[1:-1]]
    edges = sorted(at, reverse=True)
    out, high, last = [], edges[0], 0
    for hi, lo in zip(edges, edges[1:], strict=False):
        middle = (hi + lo) / 2
        if at[hi] == at[lo] > last and hi - lo > 1e-3 * (high - hi) and (at[hi] - last >= WANTED or at[hi] >= most):
            out.append((float(middle), float(high), at[hi] - last))
            high, last = middle, at[hi]
            if last >= most:
                return out
    return [*out, (float(edges[-1] - top * 1e-3), float(high), len(v) - last)] if last < len(v) else out


def eigenpairs(spark: SparkSession, v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues of ``v`` and their eigenvectors, falling; a task for each interval."""
    shared = spark.sparkContext.broadcast(v)
    found = intervals(spark, shared, most)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for low, high, count in zip(batch["low"], batch["high"], batch["count"], strict=True):
                values, vectors = feast(shared.value, low, high, count)
                yield pd.DataFrame({"value": values, "vector": list(vectors.T)})

    made = spark.createDataFrame(found, "low double, high double, count long").repartition(max(1, len(found)))
    pairs = sorted(made.mapInPandas(run, "value double, vector array<double>").collect(), key=lambda r: -r["value"])[:most]
    return np.array([p["value"] for p in pairs]), np.array([p["vector"] for p in pairs]).reshape(-1, len(v)).T


def moments(rows: DataFrame, of, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums, and sums of products, of ``of(block)`` over all rows: upper triangles by task, summed by place."""
    up, right = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(size), np.zeros((size, size))
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                y = of(_block(batch.slice(lo, 4096)))
                sums += y.sum(axis=0)
                products += y.T @ y
        places = np.arange(size + len(up))
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(np.append(sums, products[up, right]))], ["_place", "_sum"])

    total = rows.select("_x").mapInArrow(run, "_place long, _sum double").groupBy("_place").agg(F.sum("_sum").alias("_sum")).toArrow().to_pandas()
    flat = np.zeros(size + len(up))
    flat[total["_place"]] = total["_sum"]
    products = np.zeros((size, size))
    products[up, right] = products[right, up] = flat[size:]
    return flat[:size], products


def fit(rows: DataFrame, n: int, sums: list[int], most: int) -> Fit:
    """Components of the x-vectors. Each dimension is centred at the whole number next to its mean, so products are exact sums of whole numbers up to 2^53."""
    center = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    first, second = moments(rows, lambda x: (x - center).astype(float), len(sums))
    rest = np.array([(s - n * int(c)) / n for s, c in zip(sums, center, strict=True)])
    v = second / n - np.outer(rest, rest)
    values, vectors = eigenpairs(rows.sparkSession, v, most) if np.trace(v) > 0 else (np.empty(0), np.empty((len(sums), 0)))
    keep = values > LEAST * values.max(initial=0)
    return Fit(n, sums, center, rest, values[keep], vectors[:, keep], float(np.trace(v)))


def whitened(model: Fit, x: np.ndarray) -> np.ndarray:
    return ((x - model.center).astype(float) - model.rest) @ model.vectors / np.sqrt(model.values)


def deviations(model: Fit, x: np.ndarray) -> list:
    """The exact sum over dimensions of (n * x - S)^2 of each row, None where a long can't hold it."""
    far = np.abs(x.astype(float)).max(initial=0) * model.n + max(map(abs, model.sums))
    near = np.abs((x - model.center).astype(float) - model.rest).max(initial=0) * model.n + 1
    if far < 2.0**62 and near * near * x.shape[1] < 2.0**62:
        difference = model.n * x - np.array(model.sums, np.int64)
        return (difference * difference).sum(axis=1).tolist()
    exact = [int(((model.n * row.astype(object) - np.array(model.sums, object)) ** 2).sum()) for row in x]
    return [e if e < 2**63 else None for e in exact]


def whiten(vectors: DataFrame, most: int = 32, id_column="vec_id", vector_column="embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``, a row for each vector and component.

    Vectors become whole numbers, once, as a table. Tasks sum these and their centred products; the covariance (dimensions squared) is
    the only thing that the driver holds. Its largest eigenvalues are parted into intervals by counts of inertia, a task for each shift, and each interval's
    eigenpairs are found by contour integration in a task of its own; the counts make sure that none is missed. A last pass measures the
    covariance of what was whitened, whose largest distance from the identity every row carries.

    Rows whose vector is null, empty, or holds null or non-finite components are left out, and so are rows of another length than most (of
    equally frequent lengths the smallest stays). Rows without an id and rows that repeat stay, each on its own. Components end where the
    variance falls below ``LEAST`` of the largest; a table of equal vectors has none, so it gives no rows, as an empty table does. Components
    beyond 2^54 count as 2^54. A deviation beyond a long is null. Other columns, however named, are left out.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[id_column].dataType.simpleString()
    made = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = written(whole_vectors(vectors, id_column, vector_column), "whitening-vectors")
    usual = rows.groupBy(F.size("_x").alias("_size")).count().orderBy(F.desc("count"), "_size").first()
    if usual is None:
        return spark.createDataFrame([], made)
    size, n = usual["_size"], usual["count"]
    rows = rows.where(F.size("_x") == size)
    model = fit(rows, n, dimension_sums(rows, size), most)
    k = len(model.values)
    if not k:
        return spark.createDataFrame([], made)
    first, second = moments(rows, lambda x: whitened(model, x), k)
    error = float(np.abs(second / n - np.outer(first / n, first / n) - np.eye(k)).max())
    explained = model.values / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                x, m = _block(part), part.num_rows
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)), pa.array(deviations(model, x), pa.int64()).take(each),
                     pa.array(whitened(model, x).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, made)


def dimension_sums(rows: DataFrame, size: int) -> list[int]:
    """Exact sums by dimension, as numbers of any length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, size), np.int64)
        for batch in batches:
            x = _block(batch)
            total += (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total[0]), pa.array(total[1])], ["_place", "_high", "_low"])

    sums = rows.select("_x").mapInArrow(run, "_place long, _high long, _low long").groupBy("_place").agg(F.sum(F.col("_high").cast("decimal(38,0)")).alias("h"), F.sum(F.col("_low").cast("decimal(38,0)")).alias("l")).collect()
    return [(int(r["h"]) << 32) + int(r["l"]) for r in sorted(sums)]
