"""Rounds of boosted trees chosen by the AUC of validation rows, and categories as out-of-fold label means."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from snapmart.operators import boosting, models
from snapmart.operators.target_encoding import FOLDS, fit_target_encoding, fold_of


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(3)
    x, z = rng.normal(size=(2, 500))
    rows = [(i, float(a), float(b), int(rng.random() < 1 / (1 + math.exp(-2 * a * b))), f"c{i % 7}") for i, (a, b) in enumerate(zip(x, z, strict=True))]
    return spark.createDataFrame(rows, "id int, x double, z double, y int, c string").repartition(3).cache()


@pytest.fixture(scope="module")
def ensemble(frame):
    data = VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(frame)
    return GBTClassifier(labelCol="y", maxIter=12, maxDepth=4, stepSize=0.3, seed=1).fit(data.filter("id % 3 > 0")), data


def pairwise_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    return np.mean([(a > neg).mean() + (a == neg).mean() / 2 for a in pos])


def test_margins_after_every_round(ensemble):
    model, data = ensemble
    got = boosting.staged_margins(model, data.orderBy("id").coalesce(1), "y").collect()
    vectors = [r["features"] for r in data.orderBy("id").collect()]
    want = np.cumsum([[w * t.predict(v) for t, w in zip(model.trees, model.treeWeights, strict=True)] for v in vectors], axis=1)
    assert np.allclose([r["margins"] for r in got], want, rtol=1e-12, atol=1e-12)
    p = [r["probability"][1] for r in model.transform(data.orderBy("id").coalesce(1)).collect()]
    assert np.allclose(1 / (1 + np.exp(-2 * want[:, -1])), p)


def test_auc_of_all_rounds_in_one_aggregate(ensemble):
    model, data = ensemble
    rows = boosting.staged_margins(model, data.filter("id % 3 = 0"), "y")
    y, margins = (np.array([r[c] for r in rows.collect()]) for c in ("y", "margins"))
    got = {r["round"]: r["auc"] for r in boosting.round_auc(boosting.by_round(rows)).collect()}
    assert got == {k + 1: pytest.approx(pairwise_auc(y, margins[:, k])) for k in range(12)}


def patient(aucs, patience):
    """(best round, last round, stopped) by reading one round after the other."""
    best = 0
    for k, auc in enumerate(aucs, 1):
        if auc is not None and (best == 0 or auc > aucs[best - 1]):
            best = k
        if best and k - best >= patience:
            return best, k, True
    return (best, len(aucs), False) if best else None


def test_patience_against_a_loop(spark):
    rng = np.random.default_rng(6)
    cases = {f"m{i}": [float(a) for a in rng.integers(0, 6, rng.integers(1, 25)) / 8] for i in range(60)}
    cases |= {"flat": [0.5] * 9, "none": [None] * 4, "late": [0.1] * 3 + [0.2] * 3 + [0.3] * 3, "one": [0.7]}
    rows = spark.createDataFrame([(m, k, a) for m, aucs in cases.items() for k, a in enumerate(aucs, 1)], "m string, round int, auc double")
    for patience in (1, 3, 50):
        got = {r["m"]: (r["best_round"], r["last_round"], r["stopped"]) for r in boosting.best_rounds(rows, ["m"], patience).collect()}
        assert got == {m: patient(aucs, patience) for m, aucs in cases.items() if patient(aucs, patience)}
    alone = boosting.best_rounds(rows.filter("m = 'late'").drop("m"), patience=3).collect()
    assert [(r["best_round"], r["best_auc"], r["last_round"], r["stopped"]) for r in alone] == [(7, 0.3, 9, False)]
    assert boosting.best_rounds(rows.filter("m = 'none'").drop("m")).collect() == []


def test_trees_end_at_the_best_round(frame, monkeypatch):
    monkeypatch.setattr(models, "FIRST_ROUNDS", 4)
    train, test = frame.filter("id % 3 > 0"), frame.filter("id % 3 = 0")
    model = models.fit_boosted_trees(train, test, "y", ["x", "z"], ["c"], max_iter=40, step=0.3, depth=3, patience=5)
    whole = models.fit_boosted_trees(train, None, "y", ["x", "z"], ["c"], max_iter=min(40, model.info["rounds"] + 5), step=0.3, depth=3)
    assert whole.info["rounds"] == min(40, model.info["rounds"] + 5) and whole.info["best_auc"] is None
    ready = whole.pipeline.stages[0].transform(whole.features.transform(test))
    aucs = [r["auc"] for r in boosting.round_auc(boosting.by_round(boosting.staged_margins(whole.pipeline.stages[-1], ready, "y"))).orderBy("round").collect()]
    assert patient(aucs, 5)[0] == model.info["rounds"] and model.info["best_auc"] == pytest.approx(max(aucs))
    y, p = (np.array([r[c] for r in model.score(test).collect()]) for c in ("y", "p"))
    assert pairwise_auc(y, p) == pytest.approx(model.info["best_auc"])


def test_validation_rows_of_one_class_end_nothing(frame):
    model = models.fit_boosted_trees(frame, frame.filter("y = 1"), "y", ["x"], [], max_iter=3, depth=2)
    assert model.info["rounds"] == 3 and model.info["best_auc"] is None


def brute_encoding(rows, smoothing=10.0):
    """{id: value without the row's own fold}, by loops."""
    fold = {r["id"]: int(hashlib.md5(str(r["id"]).encode()).hexdigest()[:8], 16) % FOLDS for r in rows}
    out = {}
    for r in rows:
        others = [o for o in rows if fold[o["id"]] != fold[r["id"]] and o["y"] is not None]
        prior = np.mean([o["y"] for o in others])
        same = [o["y"] for o in others if o["c"] == r["c"] and r["c"] is not None]
        out[r["id"]] = (sum(same) + smoothing * prior) / (len(same) + smoothing)
    return out


def test_encoding_out_of_fold_against_loops(spark):
    rng = np.random.default_rng(8)
    rows = [(i, "hot" if i % 3 == 0 else f"v{int(rng.integers(0, 30))}", int(rng.random() < 0.4)) for i in range(200)]
    rows += [(200, None, 1), (201, "hot", None), (202, "alone", 1)]
    df = spark.createDataFrame(rows, "id int, c string, y int")
    fitted = fit_target_encoding(df, "y", ["c"], ["id"])
    got = {r["id"]: r["c_mean"] for r in fitted.transform(df, fold_of(["id"]), "_mean").collect()}
    assert got == {i: pytest.approx(v) for i, v in brute_encoding([r.asDict() for r in df.collect()]).items()}
    known = [r for r in rows if r[2] is not None]
    mean = sum(r[2] for r in known) / len(known)
    hot = [r[2] for r in known if r[1] == "hot"]
    new = {r["c"]: r["c"] and r["e"] for r in fitted.transform(spark.createDataFrame([("hot",), ("never",)], "c string"), suffix="_mean").withColumnRenamed("c_mean", "e").collect()}
    assert new == {"hot": pytest.approx((sum(hot) + 10 * mean) / (len(hot) + 10)), "never": pytest.approx(mean)}


def test_one_text_per_row_is_fitted_without_a_collect(spark, monkeypatch):
    """Every row its own category: nothing but totals and a few counts reaches the driver."""
    from pyspark.sql.classic.dataframe import DataFrame

    rows = spark.range(3000).select(F.col("id").cast("int").alias("id"), F.concat(F.lit("text "), F.col("id")).alias("c"), (F.col("id") % 9 / 9.0).alias("x"),
                                    (F.xxhash64("id") % 2 == 0).cast("int").alias("y"))
    collected = []
    collect = DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: collected.append(len(found := collect(self))) or found)
    model = models.fit_boosted_trees(rows, None, "y", ["x"], ["c"], max_iter=2, depth=2, key=["id"])
    assert model.features.encoding.table.count() == 3000 and max(collected) <= 16
    assert model.features.vocabulary is None and model.score(rows.limit(5)).count() == 5


def test_no_round_is_fitted_or_judged_for_its_number_alone(frame, monkeypatch):
    """The cut model is the first trees of the last fit, and each fit judges its new rounds only."""
    monkeypatch.setattr(models, "FIRST_ROUNDS", 4)
    fits, judged = [], []
    fit, margins = models.GBTClassifier.fit, models.staged_margins
    monkeypatch.setattr(models.GBTClassifier, "fit", lambda self, data: fits.append(self.getMaxIter()) or fit(self, data))
    monkeypatch.setattr(models, "staged_margins", lambda model, rows, label, after=0: judged.append((after, model.getNumTrees)) or margins(model, rows, label, after))
    train, test = frame.filter("id % 3 > 0"), frame.filter("id % 3 = 0")
    model = models.fit_boosted_trees(train, test, "y", ["x", "z"], ["c"], max_iter=40, step=0.3, depth=3, patience=5)
    assert fits == [4 * 2 ** i for i in range(len(fits))][:-1] + [min(40, 4 * 2 ** (len(fits) - 1))]
    assert judged == list(zip([0, *fits], fits)) and model.info["rounds"] < fits[-1]
    whole = models.fit_boosted_trees(train, None, "y", ["x", "z"], ["c"], max_iter=model.info["rounds"], step=0.3, depth=3)
    got, wanted = ({r["id"]: r["p"] for r in m.score(test).collect()} for m in (model, whole))
    assert got == pytest.approx(wanted)
    importance = {r["feature"]: r["importance"] for r in models.feature_importance(model, frame.sparkSession).collect()}
    assert importance == pytest.approx({r["feature"]: r["importance"] for r in models.feature_importance(whole, frame.sparkSession).collect()})


def test_cut_model_is_stored(frame, tmp_path):
    fitted = models.fit_boosted_trees(frame, None, "y", ["x", "z"], [], max_iter=5, depth=2)
    cut = boosting.first_rounds(fitted.pipeline.stages[-1], 3)
    model = models.SnapshotModel(fitted.features, models.PipelineModel(stages=[fitted.pipeline.stages[0], cut]), fitted.info)
    model.save(frame.sparkSession, f"{tmp_path}/m")
    again = models.load_model(frame.sparkSession, f"{tmp_path}/m")
    rows = {r["id"]: r["p"] for r in model.score(frame).collect()}
    assert again.pipeline.stages[-1].getNumTrees == 3 and {r["id"]: r["p"] for r in again.score(frame).collect()} == pytest.approx(rows)


def test_validation_rows_of_one_class_leave_all_rounds(frame, monkeypatch):
    monkeypatch.setattr(models, "FIRST_ROUNDS", 2)
    assert models.fit_boosted_trees(frame, frame.filter("y = 1"), "y", ["x"], [], max_iter=5, depth=2).info["rounds"] == 5


def test_training_rows_are_shared_by_tasks(spark, monkeypatch):
    """Rows that come out of one file are fitted by several tasks."""
    monkeypatch.setattr(models, "TASK_ROWS", 100)
    rows = spark.range(400).coalesce(1).select("id", (F.col("id") % 7 / 7.0).alias("x"), (F.xxhash64("id") % 2 == 0).cast("int").alias("y"))
    found, fit = [], models.GBTClassifier.fit
    monkeypatch.setattr(models.GBTClassifier, "fit", lambda self, data: found.append(data.rdd.getNumPartitions()) or fit(self, data))
    models.fit_boosted_trees(rows, None, "y", ["x"], [], max_iter=1, depth=2, key=["id"])
    assert found[0] >= 4
