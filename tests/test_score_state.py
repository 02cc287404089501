"""Stored score counts against one pass over all scored rows."""

import random

import pytest
from pyspark.sql import functions as F

from snapmart.operators import drift, metrics
from snapmart.operators.score_state import merged, score_state, state_metrics, state_psi
from snapmart.plans.monitor import MODEL_MONTH, merge_months, monitor_state, stored_state


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice("ab"), f"2024-{rng.randint(1, 6):02d}", rng.choice([0, 1, 1, None]), rng.choice([0.25, 0.5, rng.random(), None])) for i in range(2000)]
    return spark.createDataFrame(rows, "id int, model string, month string, y int, p double").repartition(5).cache()


def close(got, want, keys):
    got, want = ({tuple(r[k] for k in keys): r.asDict() for r in df.collect()} for df in (got, want))
    assert got.keys() == want.keys() and got
    for k, row in want.items():
        assert got[k] == {c: pytest.approx(v, rel=1e-12, abs=1e-12) if isinstance(v, float) else v for c, v in row.items()}


def test_merged_states_equal_one_pass(scored):
    parts = [score_state(scored.filter(f"id % 3 = {k}"), MODEL_MONTH) for k in range(3)]
    state = merged(parts, MODEL_MONTH)
    clean = scored.filter("y IS NOT NULL AND p IS NOT NULL")
    close(state_metrics(state, MODEL_MONTH), metrics.monthly_metrics(clean, MODEL_MONTH), MODEL_MONTH)
    close(state_metrics(state, ["model"]), metrics.monthly_metrics(clean, ["model"]), ["model"])
    side = F.when(F.col("month") < "2024-03", "expected").when(F.col("month") > "2024-04", "actual")
    close(state_psi(state, side, ["model"]), drift.psi(scored, side, ["model"]), ["model"])
    assert state.agg(F.sum(F.col("pos") + F.col("neg") + F.col("other"))).first()[0] == 2000


def test_stored_months_are_replaced_or_added_to(spark, scored, tmp_path):
    root, clean = str(tmp_path), scored.filter("y IS NOT NULL AND p IS NOT NULL")
    want = metrics.monthly_metrics(clean, MODEL_MONTH)
    merge_months(clean.filter("month <= '2024-03'"), root, add=True)
    merge_months(clean.filter("month > '2024-03' AND id % 2 = 0"), root)
    april = sorted(str(f) for f in tmp_path.rglob("*.parquet") if "month=2024-01" in str(f))
    merge_months(clean.filter("month > '2024-03' AND id % 2 = 1"), root, add=True)
    close(monitor_state(spark, root), want, MODEL_MONTH)
    for _ in range(2):
        merge_months(clean.filter("month = '2024-05'"), root)
        close(monitor_state(spark, root), want, MODEL_MONTH)
    assert april == sorted(str(f) for f in tmp_path.rglob("*.parquet") if "month=2024-01" in str(f))
    close(monitor_state(spark, root, "2024-02", "2024-04"), want.filter("month BETWEEN '2024-02' AND '2024-04'"), MODEL_MONTH)
    plan = stored_state(spark, root, "2024-02", "2024-04")._jdf.queryExecution().executedPlan().toString()
    assert "2024-02" in plan.split("PartitionFilters: [")[1].split("]")[0]
    replaced = clean.filter("month = '2024-06' AND id % 5 = 0")
    merge_months(replaced, root)
    close(monitor_state(spark, root, "2024-06"), metrics.monthly_metrics(replaced, MODEL_MONTH), MODEL_MONTH)
