import numpy as np
import pytest

from snapmart.llm import whitening as W
from tests.llm.conftest import SF

MADE = "vec_id long, embedding array<double>, component string, n int, deviation int"


def frame(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    return spark.createDataFrame([(i, v if v is None else [None if c is None else float(c) for c in v], "x", 1, 2) for i, v in zip(ids, x, strict=True)], MADE)


def check(got, ids, vectors, most=32):
    """Holds rows against numpy's own eigenvectors, each up to its sign."""
    x = np.floor(np.asarray(vectors, float) * 64) + 1_000_000
    y = x - x.mean(axis=0)
    v = y.T @ y / len(y)
    values, basis = np.linalg.eigh(v)
    values, basis = values[::-1], basis[:, ::-1]
    k = min(most, int((values > W.LEAST * values[0]).sum()))
    sums = x.astype(np.int64).astype(object).sum(axis=0)
    rows = got.toPandas().sort_values(["component", "vec_id", "deviation"], kind="stable")
    assert list(rows.columns) == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert sorted(set(rows.component)) == list(range(1, k + 1)) and (rows.n == len(x)).all() and len(rows) == len(x) * k
    own = [int(((len(x) * row.astype(np.int64).astype(object) - sums) ** 2).sum()) for row in x]
    order = np.lexsort((np.array(own, float), ids))
    deviation = [own[i] for i in order]
    w = rows.whitened.to_numpy().reshape(k, -1).T
    for j in range(k):
        part = rows[rows.component == j + 1]
        assert part.vec_id.tolist() == [ids[i] for i in order] and part.deviation.tolist() == deviation
        assert np.allclose(part.explained, values[j] / values.sum(), rtol=1e-9, atol=0)
    want = (y @ basis[:, :k] / np.sqrt(values[:k]))[order]
    apart = np.array([j for j in range(k) if all(abs(values[j] - values[i]) > 1e-6 * values[0] for i in range(len(values)) if i != j)], int)
    sign = np.sign((w * want).sum(axis=0))
    assert np.abs(w[:, apart] - (want * sign)[:, apart]).max(initial=0) < 1e-6
    error = np.abs(np.cov(w.T, bias=True).reshape(k, k) - np.eye(k)).max()
    assert error < 1e-4 and (rows.identity_error < 1e-4).all() and rows.identity_error.nunique() == 1
    return values


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = df.collect()
    check(W.whiten(df), [r["vec_id"] for r in rows], [r["embedding"] for r in rows])


def test_skewed_spectrum_and_few_dimensions(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 40)) * np.geomspace(1000, 0.5, 40) + 10
    check(W.whiten(frame(spark, x)), range(400), x)
    check(W.whiten(frame(spark, x[:, :3])), range(400), x[:, :3])
    check(W.whiten(frame(spark, x), most=5), range(400), x, 5)


def test_equal_eigenvalues(spark):
    x = np.vstack([np.eye(12), -np.eye(12)]) * 4
    values = check(W.whiten(frame(spark, x)), range(24), x)
    assert np.allclose(values, values[0])


def test_low_rank_and_repeated_rows(spark):
    x = np.repeat([[1.0, 2, 0, 0], [3, 1, 0, 0], [0, 0, 0, 0]], [5, 1, 2], axis=0)
    ids = [1, 1, 1, 2, 3, 4, 5, 6]
    got = W.whiten(frame(spark, x, ids))
    assert got.count() == 16
    check(got, ids, x)


@pytest.mark.parametrize("seed", range(4))
def test_inertia(seed):
    rng = np.random.default_rng(seed)
    for a in (rng.normal(size=(30, 30)), np.diag(rng.integers(-2, 3, 12).astype(float)), np.kron(np.eye(4), [[0.0, 1], [1, 0]]), np.zeros((3, 3))):
        a = (a + a.T) / 2
        w = np.linalg.eigvalsh(a)
        assert W.inertia(a) == ((w > 1e-12).sum(), (w < -1e-12).sum())


def test_contour_finds_all_and_only_what_lies_inside():
    rng = np.random.default_rng(9)
    q = np.linalg.qr(rng.normal(size=(50, 50)))[0]
    values = np.sort(np.concatenate([np.linspace(0, 1, 30), [2, 2, 2, 2 + 1e-9, 2.5], np.geomspace(3, 1e5, 15)]))
    v = (q * values) @ q.T
    for low, high in ((1.5, 2.7), (2.7, 1e6), (-1, 1.5), (0.5, 0.75)):
        inside = values[(values > low) & (values < high)]
        count = W.inertia(v - low * np.eye(50))[0] - W.inertia(v - high * np.eye(50))[0]
        assert count == len(inside)
        got, vectors = W.feast((v + v.T) / 2, low, high, count)
        assert np.allclose(got, inside[::-1], rtol=0, atol=1e-9) and np.abs(v @ vectors - vectors * got).max() < 1e-8
        assert np.abs(vectors.T @ vectors - np.eye(count)).max() < 1e-10


def test_missed_pairs_are_told():
    with pytest.raises(ArithmeticError):
        W.feast(np.diag([1.0, 2.0, 3.0]), 0.5, 1.5, 2)


def test_edge_cases(spark):
    good = [[1.0, 2.0], [2.0, 0.5], [0.0, 0.0], [-3.0, 1.0], [1.0, 2.0]]
    bad = [None, [], [1.0, None], [float("nan"), 1.0], [1.0, float("inf")], [1.0, 2.0, 3.0]]
    ids = [0, 20, 20, 40, 0]
    check(W.whiten(frame(spark, good + bad, ids + [7] * len(bad))), ids, good)
    null = W.whiten(frame(spark, good, [None, *ids[1:]]))
    assert null.count() == 10 and null.where("vec_id IS NULL").count() == 2
    for x in ([], bad[:4], [[1.0, 2.0]], [[1.0, 2.0]] * 3):
        assert W.whiten(frame(spark, x)).count() == 0
    large = W.whiten(frame(spark, [[1e300, 1.0], [-1e300, 2.0], [5.0, 3.0]])).collect()
    assert large and all(r["deviation"] is None for r in large if r["vec_id"] < 2)
