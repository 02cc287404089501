import numpy as np
from pyspark.sql import functions as F

from snapmart.llm import neighbours
from tests.llm.conftest import SF


def brute(ids, x, queries, k=20):
    out = {}
    for q in queries:
        i = list(ids).index(q)
        s = x @ x[i]
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def by_query(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


def test_recall_over_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PART_ROWS", 100)
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(40, 24))
    x = (centers[rng.integers(0, 40, 3000)] + 0.4 * rng.normal(size=(3000, 24))).astype(np.float32).astype(float)
    router, visits = neighbours.fit(x, 3000, 20)
    assert router.second.shape[1] >= 16 and visits < router.second.shape[1]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = by_query(neighbours.search(df, F.col("vec_id") % 20 == 0))
    want = brute(np.arange(3000), x, range(0, 3000, 20))
    assert got.keys() == want.keys() and all(len(g) == 20 for g in got.values())
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = df.collect()
    got = by_query(neighbours.search(df, F.col("vec_id") % 20 == 0))
    want = brute(np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float), [r["vec_id"] for r in rows if r["vec_id"] % 20 == 0])
    assert got.keys() == want.keys()
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9
    assert all(abs(s - dict(want[q]).get(i, s)) < 1e-9 for q in want for i, s in got[q])


def test_blocks_and_a_very_common_vector(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    rng = np.random.default_rng(5)
    x = np.vstack([rng.normal(size=(150, 6)), np.tile([[3.0, 0, 0, 1, 0, 0]], (80, 1))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = by_query(neighbours.search(df, F.col("vec_id") % 20 == 0))
    want = brute(np.arange(230), x, range(0, 230, 20))
    assert {q: [i for i, _ in g] for q, g in got.items()} == {q: [i for i, _ in g] for q, g in want.items()}


def test_edge_cases(spark):
    schema = "vec_id bigint, embedding array<float>, rank int, score string"
    made = [(0, [1.0, 2.0], 1, "x"), (20, [1.0, 2.0], 1, "x"), (20, [1.0, 2.0], 1, "x"), (40, None, None, None), (60, [0.0, 0.0], 1, "x"), (80, [1.0, None], 1, "x"),
            (100, [float("nan"), 1.0], 1, "x"), (120, [float("inf"), 1.0], 1, "x"), (None, [1.0, 1.0], 1, "x"), (1, [2.0, 0.5], 1, "x"), (2, [], 1, "x"), (3, [1.0, 2.0, 3.0], 1, "x")]
    got = by_query(neighbours.search(spark.createDataFrame(made, schema), F.col("vec_id") % 20 == 0))
    assert {q: [i for i, _ in g] for q, g in got.items()} == {0: [20, 1], 20: [0, 1]}
    assert neighbours.search(spark.createDataFrame([], schema), F.col("vec_id") % 20 == 0).count() == 0
    assert neighbours.search(spark.createDataFrame(made[3:6], schema), F.col("vec_id") % 20 == 0).count() == 0


def test_repeated_rows_of_a_vector_that_many_ids_share(spark):
    far = [(100 + i, [0.1, 0.01 * i, 0.0]) for i in range(40)]
    shared = [(i, [3.0, 1.0, 0.0]) for i in range(40)]
    for made in ([*far, *[shared[5]] * 21, *shared], [*far, *shared, *shared]):
        got = by_query(neighbours.search(spark.createDataFrame(made, "vec_id bigint, embedding array<double>"), F.col("vec_id") % 20 == 0))
        rows = dict(made)
        ids = np.array(sorted(rows))
        want = brute(ids, np.array([rows[i] for i in ids]), [i for i in ids if i % 20 == 0])
        assert {q: [i for i, _ in g] for q, g in got.items()} == {q: [i for i, _ in g] for q, g in want.items()}
