"""From CSV files to monitored models: every stage written below one root."""

from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.functions.labels import map_binary_label
from snapmart.operators.metrics import monthly_metrics
from snapmart.operators.schema import label_column
from snapmart.operators.splits import snapshot_range
from snapmart.plans.layers import run_gold_dedup, run_ledgered_layers
from snapmart.plans.training import predict_latest, ready_for, train_logistic, train_trees
from snapmart.sources.csv import read_csv_any, write_csv
from snapmart.sources.ledger import Ledger
from snapmart.sources.layers import layer_path, read_snapshots
from snapmart.sources.models import load_latest

MODELS = ("logistic", "trees")


def monitor_stored(spark: SparkSession, root: str, start: str, end: str, key: str = "customerID", snap: str = "snapdate") -> DataFrame:
    """Monthly metrics of the newest versions of both stored models over gold snapshots; the summary is written."""
    gold = read_snapshots(spark, layer_path(root, "gold", "gold"))
    label = label_column(gold)
    frame = snapshot_range(gold, start, end, snap).withColumn(label, map_binary_label(F.col(label))).filter(F.col(label).isNotNull())
    scored = []
    for name in MODELS:
        model = load_latest(spark, root, name)
        ready = ready_for(model, frame, key, snap, keep={snap: "date", label: "int"})
        scored.append(model.score(ready).select(F.lit(name).alias("model"), F.trunc(snap, "month").alias("month"), key,
                                                F.col(label).alias("y"), "p"))
    report = monthly_metrics(reduce(DataFrame.unionByName, scored), ["model", "month"])
    write_csv(report, f"{root}/monitor_summary")
    return spark.read.csv(f"{root}/monitor_summary", header=True, inferSchema=True)


def run_end_to_end(spark: SparkSession, sources: dict[str, str], root: str, train: tuple, oot: tuple, key: str = "customerID",
                   snap: str = "snapdate", **options) -> DataFrame:
    """CSV paths (``label`` and feature tables) to bronze, silver, gold, both models, predictions and the monitor's report, which is returned.

    Each stage has an entry in the ledger below ``root``; a rerun skips the stages whose inputs and parameters are those of their entries.
    """
    ledger, path = Ledger(spark, root), layer_path(root, "gold", "gold")
    joined = run_ledgered_layers(spark, {name: read_csv_any(spark, source) for name, source in sources.items()}, root)
    n_gold = partial(ledger.rows, path)
    unique = ledger.step("gold/dedup", [joined], n_gold, path, partial(run_gold_dedup, spark, root, key, snap), (key, snap))

    def gold() -> DataFrame:
        return read_snapshots(spark, path)

    asked = sorted(options.items())
    fits = {"logistic": (lambda: train_logistic(gold(), root, *train, key=key, snap=snap), (train, key, snap)),
            "trees": (lambda: train_trees(gold(), root, train, oot, key=key, snap=snap, **options), (train, oot, key, snap, asked))}
    fitted = {name: ledger.step(f"train/{name}", [unique], n_gold, f"{root}/{name}_scores", *fits[name]) for name in MODELS}
    for name in MODELS:
        ledger.step(f"predict/{name}", [fitted[name]], n_gold, f"{root}/{name}_predictions", lambda m=name: predict_latest(gold(), root, m, key, snap), (key, snap), "csv")
    ledger.step("monitor", list(fitted.values()), n_gold, f"{root}/monitor_summary", lambda: monitor_stored(spark, root, *oot, key, snap), (oot, key, snap), "csv")
    return spark.read.csv(f"{root}/monitor_summary", header=True, inferSchema=True)


def stage_counts(spark: SparkSession, root: str) -> DataFrame:
    """(stage, n) of what the later stages have written."""
    tables = {"gold": spark.read.parquet(layer_path(root, "gold", "gold")), "monitor": spark.read.csv(f"{root}/monitor_summary", header=True)}
    tables |= {f"{name}_predictions": spark.read.csv(f"{root}/{name}_predictions", header=True) for name in MODELS}
    tables |= {f"{name}_scores": spark.read.parquet(f"{root}/{name}_scores") for name in MODELS}
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("stage"), "n") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)
