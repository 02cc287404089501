"""Month-by-month monitoring of several models in one job."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.operators.lookup import staged_lookup
from snapmart.operators.metrics import monthly_metrics
from snapmart.operators.models import SnapshotModel
from snapmart.operators.score_state import merged, score_state, state_metrics
from snapmart.operators.splits import snapshot_range
from snapmart.sources.csv import can_read, write_csv
from snapmart.sources.layers import write_json

MODEL_MONTH = ["model", "month"]


def score_months(gold: DataFrame, models: dict[str, SnapshotModel], label: str, start: str, end: str,
                 key: str = "customerID", snap: str = "snapdate") -> DataFrame:
    """(model, month, key, y, p) of all models over the snapshots from ``start`` to ``end``."""
    frame = snapshot_range(gold, start, end, snap)
    scored = [
        m.score(frame).select(F.lit(name).alias("model"), F.trunc(snap, "month").alias("month"), key,
                              F.col(label).cast("int").alias("y"), "p")
        for name, m in models.items()]
    return reduce(DataFrame.unionByName, scored)


def merge_months(scored: DataFrame, root: str, add: bool = False) -> None:
    """Scored rows (model, month, y, p) into the stored score state below ``root``.

    Months that are there already are replaced, so scoring a month again changes nothing; with ``add`` the rows are further rows of
    their months. Only the partitions concerned are written, from a copy in the shared folder.
    """
    spark, path = scored.sparkSession, f"{root}/score_state"
    state = score_state(scored.select(*MODEL_MONTH, "y", "p"), MODEL_MONTH)
    if add and can_read(spark, path):
        known = stored_state(spark, root)
        theirs = known.join(state.select(*MODEL_MONTH).distinct(), MODEL_MONTH, "left_semi")
        state = merged([state, theirs.select(*state.columns)], MODEL_MONTH)
    (staged_lookup(state).hint("rebalance", *MODEL_MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*MODEL_MONTH).parquet(path))


def stored_state(spark: SparkSession, root: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """The score state of an inclusive range of months; the range prunes directories."""
    schema = "p double, pos bigint, neg bigint, other bigint, model string, month string"
    state = spark.read.schema(schema).parquet(f"{root}/score_state")
    kept = state if start is None else state.filter(F.col("month") >= start)
    return kept if end is None else kept.filter(F.col("month") <= end)


def monitor_state(spark: SparkSession, root: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Metrics by model and month of the stored state; nothing is scored."""
    return state_metrics(stored_state(spark, root, start, end), MODEL_MONTH)


def monitor(gold: DataFrame, models: dict[str, SnapshotModel], label: str, start: str, end: str,
            key: str = "customerID", snap: str = "snapdate", root: str | None = None) -> DataFrame:
    """Metrics by model and month; with ``root`` they are also written there, as CSV and JSON."""
    report = monthly_metrics(score_months(gold, models, label, start, end, key, snap), ["model", "month"])
    if root is not None:
        report = staged_lookup(report)
        write_csv(report, f"{root}/monitor_summary")
        write_json(report, f"{root}/monitor_json")
    return report
