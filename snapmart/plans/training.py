"""Training frames, model matrices, evaluation of fitted models."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from snapmart.functions.dates import month_of
from snapmart.functions.labels import map_binary_label
from snapmart.operators.drift import psi, psi_grade
from snapmart.operators.features import calendar_features, fill_missing
from snapmart.operators.lookup import staged_lookup
from snapmart.operators.metrics import metrics_long, score_summary, threshold_columns
from snapmart.operators.models import (SnapshotModel, coefficients, feature_importance, fit_boosted_trees,
                                       fit_logistic)
from snapmart.operators.rows import keep_last, normalize_key, require_columns, sanitize_tokens
from snapmart.operators.schema import (KEY_NAMES, align_to_schema, cast_numeric_text, label_column, numeric_columns,
                                       text_columns)
from snapmart.operators.splits import latest_snapshot, month_range_label, snapshot_range, stratified_split, time_split
from snapmart.sources.csv import write_csv
from snapmart.sources.layers import write_json
from snapmart.sources.models import load_latest, save_version

TRAIN_RANGE = ("2023-02-01", "2024-04-01")
OOT_RANGE = ("2024-05-01", "2024-09-01")
REPORTED = {"accuracy": "Accuracy", "auc": "AUC-ROC", "precision": "Precision", "recall": "Recall"}


def training_frame(gold: DataFrame, start: str = TRAIN_RANGE[0], end: str = TRAIN_RANGE[1],
                   key: str = "customerID", snap: str = "snapdate", order: str | None = "ord_") -> DataFrame:
    """Labelled rows of the training months: 0/1 label, month dates, last row per (key, month).

    The date filter runs first, so that it reaches the partitions of the scan. Without an ordinal (``order`` is None or
    missing) the row with the last full date stays.
    """
    label = label_column(gold)
    if label is None:
        raise ValueError("no label column")
    df = normalize_key(require_columns(gold, key, snap), key)
    last_day = F.last_day(F.lit(end).cast("date"))
    df = df.filter(F.col(snap).between(F.trunc(F.lit(start).cast("date"), "month"), last_day))
    df = df.withColumn("_when", F.col(snap)).withColumn(snap, month_of(F.col(snap)).cast("date")).withColumn(label, map_binary_label(F.col(label)))
    df = snapshot_range(df.filter(F.col(label).isNotNull()), start, end, snap)
    if label != "Churn":
        df = df.withColumnRenamed(label, "Churn")
    return keep_last(df, [key, snap], order if order in df.columns else "_when").drop("_when")


def model_matrix(df: DataFrame, label: str, keep=(), fit_on: DataFrame | None = None) -> DataFrame:
    """Features ready for a tree model: calendar parts instead of dates, no NULL, no key columns.

    Columns in ``keep`` (and the label) pass through for the output.
    """
    keep = [label, *keep]
    def prepared(frame):
        features = frame.drop(*[c for c in KEY_NAMES if c in frame.columns and c not in keep])
        return calendar_features(features)
    return fill_missing(prepared(df), None if fit_on is None else prepared(fit_on), exclude=keep)


def evaluate(scores: DataFrame, groups: list, y: str = "y", p: str = "p", threshold: float = 0.5) -> DataFrame:
    """Confusion matrix, threshold metrics and AUC per data set."""
    summary = score_summary(scores, groups, y, p, threshold)
    return summary.select(*groups, "tn", "fp", "fn", "tp", *[e.alias(n) for n, e in threshold_columns().items()], "auc")


def drift_grade(scores: DataFrame, side: Column, groups: list = (), p: str = "p") -> DataFrame:
    """PSI between two sides of the scores with its grade."""
    return psi(scores, side, groups, p).withColumn("grade", psi_grade(F.col("psi")))


def feature_columns(df: DataFrame, exclude) -> tuple[list, list]:
    """Numeric and categorical feature columns; dates of other tables are no features."""
    return numeric_columns(df, exclude), text_columns(df, exclude)


def train_logistic(gold: DataFrame, root: str, start: str = TRAIN_RANGE[0], end: str = TRAIN_RANGE[1],
                   key: str = "customerID", snap: str = "snapdate", order: str | None = None) -> DataFrame:
    """Logistic path: split the training months by time, fit on train, evaluate every split.

    Stores the model version, scores by split, coefficients and a summary below ``root`` and
    returns the evaluation per split.
    """
    spark = gold.sparkSession
    frame = training_frame(gold, start, end, key, snap, order)
    skip = (key, snap, "Churn", "split")
    df = staged_lookup(time_split(cast_numeric_text(sanitize_tokens(frame, protected=skip), exclude=skip), snap))
    numeric, categorical = feature_columns(df, skip)
    model = fit_logistic(df.filter("split = 'train'"), "Churn", numeric, categorical)
    save_version(spark, model, root, "logistic")
    scores = staged_lookup(model.score(df).select(key, snap, "split", F.col("Churn").alias("y"), "p"))
    scores.write.mode("overwrite").partitionBy("split").parquet(f"{root}/logistic_scores")
    write_csv(coefficients(model, spark), f"{root}/logistic_coefficients")
    report = staged_lookup(evaluate(scores, ["split"]))
    write_json(report.join(df.groupBy("split").agg(F.count(F.lit(1)).alias("n")), "split").withColumns({
        "n_numeric": F.lit(len(numeric)), "n_categorical": F.lit(len(categorical))}), f"{root}/logistic_summary")
    return report


def train_trees(gold: DataFrame, root: str, train: tuple = TRAIN_RANGE, oot: tuple = OOT_RANGE,
                key: str = "customerID", snap: str = "snapdate", **options) -> DataFrame:
    """Tree path: stratified hold-out inside the training months, out-of-time months after them.

    Fill values are fitted on the training months only. Stores the model version, scores,
    importance and long metrics below ``root`` and returns the evaluation per data set, with
    the drift from hold-out to out-of-time scores.
    """
    spark = gold.sparkSession
    label = label_column(gold)
    coded = gold.withColumn(label, map_binary_label(F.col(label))).filter(F.col(label).isNotNull())
    ranged = coded.withColumn("_range", month_range_label(F.col(snap), {"train": train, "oot": oot}))
    monthly = ranged.filter(F.col("_range").isNotNull()).withColumn("_month", F.date_format(snap, "yyyy-MM-dd"))
    df = staged_lookup(calendar_features(cast_numeric_text(monthly, exclude=(key, label, "_range", "_month"))))
    parts = stratified_split(df.filter("_range = 'train'"), label, [key, "_month"])
    keep = (key, label, "_range", "_month", "part")
    numeric, categorical = feature_columns(parts, keep)
    model = fit_boosted_trees(parts.filter("part = 'train'"), parts.filter("part = 'test'"), label, numeric, categorical, key=[key, "_month"], **options)
    save_version(spark, model, root, "trees")
    held_out = parts.filter("part = 'test'").drop("part").withColumn("dataset", F.lit("Validation"))
    later = df.filter("_range = 'oot'").withColumn("dataset", F.lit("OOT"))
    scores = staged_lookup(model.score(held_out.unionByName(later)).select(
        key, "dataset", F.col(label).alias("y"), "p", "prediction"))
    scores.write.mode("overwrite").partitionBy("dataset").parquet(f"{root}/trees_scores")
    write_csv(feature_importance(model, spark), f"{root}/trees_importance")
    report = staged_lookup(evaluate(scores, ["dataset"]))
    long = metrics_long(report.withColumnRenamed("dataset", "Dataset"), ["Dataset"], REPORTED)
    write_csv(long, f"{root}/trees_metrics")
    side = F.when(F.col("dataset") == "Validation", "expected").otherwise("actual")
    drift_grade(scores, side).write.mode("overwrite").json(f"{root}/trees_drift")
    return report


def ready_for(model: SnapshotModel, frame: DataFrame, key: str = "customerID", snap: str = "snapdate", keep: dict | None = None) -> DataFrame:
    """The columns that a model was fitted on, with the key and the columns in ``keep`` (name: type)."""
    needed = {c: "double" for c in model.features.numeric} | {c: "string" for c in model.features.categorical}
    kept = frame.withColumns({f"_{c}": F.col(c) for c in keep or {}})
    dated = calendar_features(kept, [snap]) if any(c.startswith(f"{snap}_") for c in needed) else kept
    needed |= {key: "string"} | {f"_{c}": kind for c, kind in (keep or {}).items()}
    wanted = StructType.fromDDL(", ".join(f"`{c}` {t}" for c, t in needed.items()))
    # a tree model has splits on 0 for what is missing, a linear one imputes
    ready = align_to_schema(dated, wanted, fill=0 if model.info["kind"] == "trees" else None)
    return ready.withColumnsRenamed({f"_{c}": c for c in keep or {}})


def predict_latest(gold: DataFrame, root: str, name: str, key: str = "customerID", snap: str = "snapdate") -> DataFrame:
    """Newest model version applied to the newest snapshot; the key stays with the scores."""
    model = load_latest(gold.sparkSession, root, name)
    frame = latest_snapshot(gold, snap)
    frame = frame.drop(label_column(frame)) if label_column(frame) else frame
    out = model.score(ready_for(model, frame, key, snap)).select(key, "prediction", F.col("p").alias("probability"))
    write_csv(out, f"{root}/{name}_predictions")
    return out
