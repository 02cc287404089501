import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapmart.operators import models, splits
from snapmart.plans.monitor import monitor
from snapmart.plans.training import predict_latest, train_logistic, train_trees
from snapmart.sources.models import latest_version, load_latest, save_version


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(600):
        x, z = float(rng.normal(3, 2)), float(rng.exponential(50))
        c = rng.choice(["a", "b", "c"], p=[0.5, 0.3, 0.2]).item() if i > 4 else "rare"
        logit = 0.9 * (x - 3) + {"a": -1, "b": 0.5, "c": 1, "rare": 0}[c]
        rows.append((i, None if i % 40 == 7 else x, z, None if i % 50 == 9 else c, int(rng.random() < 1 / (1 + math.exp(-logit)))))
    return spark.createDataFrame(rows, "id int, x double, z double, c string, y int").repartition(4).cache()


def design(frame):
    """The same features with numpy: median, population deviation, mode, pooled one-hot."""
    rows = sorted(frame.collect(), key=lambda r: r["id"])
    cols = []
    for name in ("x", "z"):
        v = np.array([np.nan if r[name] is None else r[name] for r in rows])
        v = np.where(np.isnan(v), np.nanmedian(v), v)
        cols.append(v / np.std(v))
    c = [r["c"] or "a" for r in rows]
    pooled = [v if c.count(v) >= 10 else "__infrequent__" for v in c]
    names = sorted(set(pooled))
    cols += [np.array([float(v == n) for v in pooled]) for n in names]
    return np.column_stack(cols), np.array([r["y"] for r in rows]), ["x", "z"] + [f"c_{n}" for n in names]


def newton(X, y):
    n = len(y)
    w = np.where(y == 1, n / (2 * y.sum()), n / (2 * (n - y.sum())))
    A, beta = np.column_stack([X, np.ones(n)]), np.zeros(X.shape[1] + 1)
    ridge = np.diag([1.0] * X.shape[1] + [0.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-A @ beta))
        beta -= np.linalg.solve(A.T @ (A * (w * p * (1 - p))[:, None]) + ridge, A.T @ (w * (p - y)) + ridge @ beta)
    return beta


def test_logistic_equals_newton_solution(spark, frame):
    model = models.fit_logistic(frame, "y", ["x", "z"], ["c"])
    X, y, names = design(frame)
    beta = newton(X, y)
    got = {r["feature"]: r for r in models.coefficients(model, spark).collect()}
    assert set(got) == set(names)
    for name, b in zip(names, beta):
        assert got[name]["coef"] == pytest.approx(b, abs=1e-5) and got[name]["odds_ratio"] == pytest.approx(math.exp(b), rel=1e-4)
    p = [r["p"] for r in model.score(frame).orderBy("id").collect()]
    assert p == pytest.approx(list(1 / (1 + np.exp(-(X @ beta[:-1] + beta[-1])))), abs=1e-5)
    unknown = model.score(frame.limit(1).withColumn("c", F.lit("never seen"))).first()
    median, std = model.features.constants["median"], model.features.constants["std"]
    z = sum((unknown[n] if unknown[n] is not None else median[n]) / std[n] * b for n, b in zip(("x", "z"), beta))
    assert unknown["p"] == pytest.approx(1 / (1 + math.exp(-(z + beta[-1]))), abs=1e-5)


def test_models_reload_with_equal_scores(spark, frame, tmp_path):
    root = str(tmp_path)
    train, test = frame.filter("id % 4 != 0"), frame.filter("id % 4 = 0")
    fitted = {"logreg": models.fit_logistic(train, "y", ["x", "z"], ["c"]),
              "trees": models.fit_boosted_trees(train, test, "y", ["x", "z"], ["c"], max_iter=6, depth=3)}
    assert latest_version(spark, root, "logreg") is None
    with pytest.raises(FileNotFoundError):
        load_latest(spark, root, "logreg")
    for name, model in fitted.items():
        assert save_version(spark, model, root, name).endswith("version=1")
        assert save_version(spark, model, root, name).endswith("version=2")
        again = load_latest(spark, root, name)
        a, b = (m.score(test).select("id", "p", "prediction").orderBy("id").collect() for m in (model, again))
        assert a == b and all(0 <= r["p"] <= 1 for r in a) and len(a) == 150
    assert 1 <= fitted["trees"].info["rounds"] <= 6
    importance = models.feature_importance(fitted["trees"], spark).collect()
    assert {r["feature"] for r in importance} == {"x", "z", "c"}
    assert sum(r["importance"] for r in importance) == pytest.approx(1.0)
    months = frame.withColumn("snapdate", F.expr("make_date(2024, 5 + id % 5, 1)")).withColumnRenamed("id", "customerID")
    report = monitor(months, fitted, "y", "2024-05-01", "2024-08-01").collect()
    assert len(report) == 8 and all(r["auc"] > 0.5 and r["n"] == 120 for r in report)


def test_validation_rows_end_the_boosting(spark, frame):
    train, test = frame.filter("id % 4 != 0"), frame.filter("id % 4 = 0")
    model = models.fit_boosted_trees(train, test, "y", ["x", "z"], ["c"], max_iter=60, step=0.3, depth=3)
    assert 2 <= model.info["rounds"] < 60


def test_class_weights(spark, frame):
    weights, n = splits.class_weight_constants(frame, "y", "w_balanced")
    counts = {r["y"]: r["count"] for r in frame.groupBy("y").count().collect()}
    assert n == 600 and weights == {y: pytest.approx(600 / (2 * c)) for y, c in counts.items()}
    assert frame.select(F.sum(splits.class_weight(F.col("y"), weights))).first()[0] == pytest.approx(600)


def test_training_plans(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = []
    for m in range(1, 13):
        for i in range(60):
            charge = float(rng.normal(50, 20))
            churn = "Yes" if rng.random() < 1 / (1 + math.exp(-(charge - 50) / 10)) else "No"
            rows.append((f"C{i}", dt.date(2024, m, 1), churn, str(round(charge, 2)), rng.choice(["x", "y", "N/A"]).item()))
    gold = spark.createDataFrame(rows, "customerID string, snapdate date, Churn string, charge string, plan string")
    root = str(tmp_path)
    report = {r["split"]: r for r in train_logistic(gold, root, "2024-01-01", "2024-08-01").collect()}
    assert set(report) == {"train", "test", "monitor"} and all(r["auc"] > 0.6 for r in report.values())
    assert sum(r[c] for r in report.values() for c in ("tn", "fp", "fn", "tp")) == 480
    summary = {r["split"]: r for r in spark.read.json(f"{root}/logistic_summary").collect()}
    assert summary["monitor"]["n"] == 300 and summary["train"]["n_numeric"] == 1 and summary["train"]["n_categorical"] == 1
    assert spark.read.csv(f"{root}/logistic_coefficients", header=True).count() == 3
    report = {r["dataset"]: r for r in train_trees(gold, root, ("2024-01-01", "2024-08-01"), ("2024-09-01", "2024-11-01"),
                                                   max_iter=5, depth=3).collect()}
    assert set(report) == {"Validation", "OOT"} and all(r["auc"] > 0.6 for r in report.values())
    assert sum(report["OOT"][c] for c in ("tn", "fp", "fn", "tp")) == 180
    assert spark.read.csv(f"{root}/trees_metrics", header=True).count() == 8
    assert spark.read.json(f"{root}/trees_drift").first()["psi"] >= 0
    for name in ("logistic", "trees"):
        scored = predict_latest(gold.withColumn("charge", F.col("charge").cast("double")), root, name).collect()
        assert len(scored) == 60 and all(0 <= r["probability"] <= 1 and r["customerID"] for r in scored)
