"""Classifiers on Spark ML: fitted feature constants, training, scoring, persistence."""

import json
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.operators.boosting import PATIENCE, best_rounds, by_round, first_rounds, round_auc, staged_margins
from snapmart.operators.features import (UNKNOWN, apply_vocabulary, category_vocabulary, deviations)
from snapmart.operators.lookup import staged_lookup
from snapmart.operators.ordering import exact_medians, modes
from snapmart.operators.rows import union_all
from snapmart.operators.splits import class_weight, class_weight_constants
from snapmart.operators.target_encoding import TargetEncoding, fit_target_encoding, fold_of
from snapmart.session import workspace

INDEX, ONE_HOT, POOLED, ENCODED = "__index", "__onehot", "__pooled", "__encoded"
#: Rounds that boosting begins with; if patience has not run out by then, twice as many follow.
FIRST_ROUNDS = 128
#: Training rows that are worth a task of their own in each level of a tree.
TASK_ROWS = 10_000


@dataclass
class FeatureModel:
    """Constants fitted on the training rows only, reused for every later frame.

    ``constants`` holds one median, deviation and fill value per column; what is known of
    categories, the vocabulary or the encoding, can be long and therefore stays a table.
    """

    numeric: list
    categorical: list
    constants: dict
    vocabulary: DataFrame | None
    encoding: TargetEncoding | None = None
    _labels: list | None = None

    def transform(self, df: DataFrame, fold: Column | None = None) -> DataFrame:
        """Columns that the stages read; rows that an encoding was fitted on pass their fold."""
        c = self.constants
        out = df.withColumns({
            f"{n}{POOLED}": F.coalesce(F.col(n).cast("double"), F.lit(c["median"][n])) / F.lit(c["std"][n])
            for n in self.numeric})
        if not self.categorical:
            return out
        filled = {f"{n}{POOLED}": F.coalesce(F.col(n).cast("string"), F.lit(c["fill"][n])) for n in self.categorical}
        if self.encoding is not None:
            return self.encoding.transform(out.withColumns(filled), fold, ENCODED)
        return apply_vocabulary(out.withColumns(filled), list(filled), self.vocabulary)

    def labels(self) -> list:
        """Pooled categories per column, read once; they are the width of the model."""
        if self._labels is None:
            self._labels = self._read_labels()
        return self._labels

    def _read_labels(self) -> list:
        rows = (self.vocabulary.groupBy("column").agg(F.sort_array(F.collect_set("pooled")).alias("labels"))).collect()
        by_column = {r["column"]: list(r["labels"]) for r in rows}
        return [by_column.get(f"{n}{POOLED}", []) or [UNKNOWN] for n in self.categorical]


def fit_features(train: DataFrame, numeric, categorical, scale: bool, min_frequency: int | None,
                 fill: str | None, label: str | None = None, key=()) -> FeatureModel:
    """Fit medians, deviations, fill values (``fill`` or the mode) and the category vocabulary.

    Without a ``min_frequency`` categories are encoded by the mean of ``label`` instead, out of fold by ``key``.
    """
    numeric, categorical = list(numeric), list(categorical)
    constants = {"median": {}, "std": {}, "fill": {}}
    if numeric:
        medians = exact_medians(train, numeric)
        constants["median"] = {c: 0.0 if medians[c] is None else medians[c] for c in numeric}
        constants["std"] = {c: 1.0 for c in numeric}
        if scale:
            constants["std"] = deviations(train.select(*[
                F.coalesce(F.col(c).cast("double"), F.lit(constants["median"][c])).alias(c) for c in numeric]), numeric)
    vocabulary = encoding = None
    if categorical:
        found = modes(train, categorical) if fill is None else {}
        constants["fill"] = {c: found.get(c) or fill or UNKNOWN for c in categorical}
        names = [f"{c}{POOLED}" for c in categorical]
        filled = train.withColumns({f"{c}{POOLED}": F.coalesce(F.col(c).cast("string"), F.lit(constants["fill"][c])) for c in categorical})
        if min_frequency is None:
            encoding = fit_target_encoding(filled, label, names, key)
        else:
            vocabulary = staged_lookup(category_vocabulary(filled.select(*names), names, min_frequency))
    return FeatureModel(numeric, categorical, constants, vocabulary, encoding)


@dataclass
class SnapshotModel:
    """A fitted feature model with the Spark ML stages behind it."""

    features: FeatureModel
    pipeline: PipelineModel
    info: dict

    def score(self, df: DataFrame, threshold: float = 0.5) -> DataFrame:
        """Input columns plus ``p`` and ``prediction``; keys and labels stay attached."""
        scored = self.pipeline.transform(self.features.transform(df))
        p = vector_to_array("probability")[1]
        return (scored.withColumn("_p", p)
                .select(*df.columns, F.col("_p").alias("p"), (F.col("_p") >= threshold).cast("int").alias("prediction")))

    def save(self, spark: SparkSession, path: str) -> None:
        encoding = self.features.encoding
        self.pipeline.write().overwrite().save(f"{path}/stages")
        meta = {"numeric": self.features.numeric, "categorical": self.features.categorical, "constants": self.features.constants,
                "info": self.info, "encoded": encoding and {"columns": encoding.columns, "prior": encoding.prior}}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")
        if self.features.vocabulary is not None:
            self.features.vocabulary.write.mode("overwrite").parquet(f"{path}/vocabulary")
        if encoding is not None:
            encoding.table.write.mode("overwrite").parquet(f"{path}/encoding")


def load_model(spark: SparkSession, path: str) -> SnapshotModel:
    meta = json.loads(spark.read.text(f"{path}/meta").first()["value"])
    encoded = meta["encoded"] and TargetEncoding(meta["encoded"]["columns"], meta["encoded"]["prior"], spark.read.parquet(f"{path}/encoding"))
    vocabulary = spark.read.parquet(f"{path}/vocabulary") if meta["categorical"] and not encoded else None
    features = FeatureModel(meta["numeric"], meta["categorical"], meta["constants"], vocabulary, encoded)
    return SnapshotModel(features, PipelineModel.load(f"{path}/stages"), meta["info"])


def _indexers(features: FeatureModel) -> list:
    """One fixed indexer per column (a joint one pads short label lists with NULL)."""
    return [
        StringIndexerModel.from_labels(labels, f"{c}{POOLED}", f"{c}{INDEX}", handleInvalid="keep")
        for c, labels in zip(features.categorical, features.labels())]


def _ready(df: DataFrame, label: str) -> DataFrame:
    return df.filter(F.col(label).isNotNull()).withColumn(label, F.col(label).cast("int"))


def fit_logistic(train: DataFrame, label: str, numeric, categorical, c: float = 1.0,
                 min_frequency: int = 10, max_iter: int = 500) -> SnapshotModel:
    """L2 logistic regression with balanced class weights on scaled and one-hot features.

    The loss is divided by the sum of weights, which balanced weights make equal to the row
    count, hence the regularisation 1 / (c * rows). The slot of unknown categories is the one
    the encoder drops, so an unknown category gives zeros.
    """
    train = _ready(train, label)
    features = fit_features(train, numeric, categorical, scale=True, min_frequency=min_frequency, fill=None)
    weights, n_train = class_weight_constants(train, label, "w_balanced")
    data = features.transform(train).withColumn("weight", class_weight(F.col(label), weights))
    inputs = [f"{n}{POOLED}" for n in features.numeric] + [f"{n}{ONE_HOT}" for n in features.categorical]
    stages = []
    if features.categorical:
        stages += [*_indexers(features), OneHotEncoder(
            inputCols=[f"{n}{INDEX}" for n in features.categorical],
            outputCols=[f"{n}{ONE_HOT}" for n in features.categorical], dropLast=True)]
    stages += [VectorAssembler(inputCols=inputs, outputCol="features"),
               LogisticRegression(featuresCol="features", labelCol=label, weightCol="weight",
                                  regParam=1.0 / (c * n_train), elasticNetParam=0.0,
                                  standardization=False, maxIter=max_iter, tol=1e-8)]
    # A fitted logistic model carries its training summary, and with it the session, into every task that scores; a session
    # that has observed metrics cannot be sent there. The stored model has no summary.
    path = workspace(train.sparkSession, "logistic")
    Pipeline(stages=stages).fit(data).write().save(path)
    return SnapshotModel(features, PipelineModel.load(path), {"kind": "logistic", "label": label})


def coefficients(model: SnapshotModel, spark: SparkSession) -> DataFrame:
    """(feature, coef, odds_ratio): numeric features, then one row per kept category."""
    names = list(model.features.numeric)
    if model.features.categorical:
        for c, labels in zip(model.features.categorical, model.features.labels()):
            names += [f"{c}_{v}" for v in labels]
    coef = model.pipeline.stages[-1].coefficients.toArray()
    table = spark.createDataFrame([(n, float(b)) for n, b in zip(names, coef, strict=True)], "feature string, coef double")
    return table.withColumn("odds_ratio", F.exp("coef")).orderBy(F.desc("odds_ratio"), "feature")


def stationarity(model: SnapshotModel, train: DataFrame, label: str, c: float = 1.0, tolerance: float = 1e-5) -> DataFrame:
    """(feature, gradient, stationary) of a logistic model on its training rows.

    At the fitted coefficients the gradient of the penalised loss is zero in every feature; unlike the coefficients, that can be
    told without solving the model again. One aggregate over the rows in long form.
    """
    train = _ready(train, label)
    weights, n = class_weight_constants(train, label, "w_balanced")
    rows = model.features.transform(model.score(train))
    error = class_weight(F.col(label), weights) * (F.col("p") - F.col(label))
    numeric = [F.struct(F.lit(name).alias("feature"), (error * F.col(f"{name}{POOLED}")).alias("part")) for name in model.features.numeric]
    categories = [F.struct(F.concat(F.lit(f"{name}_"), F.col(f"{name}{POOLED}")).alias("feature"), error.alias("part")) for name in model.features.categorical]
    sums = rows.select(F.inline(F.array(*numeric, *categories))).groupBy("feature").agg((F.sum("part") / n).alias("loss"))
    fitted = coefficients(model, train.sparkSession).select("feature", "coef")
    gradient = fitted.join(sums, "feature", "left").withColumn("gradient", F.coalesce("loss", F.lit(0.0)) + F.col("coef") / (c * n))
    return gradient.select("feature", "gradient", (F.abs("gradient") <= tolerance).alias("stationary"))


def fit_boosted_trees(train: DataFrame, validation: DataFrame | None, label: str, numeric, categorical, max_iter: int = 1000, step: float = 0.03,
                      depth: int = 6, seed: int = 42, patience: int = PATIENCE, key=None) -> SnapshotModel:
    """Boosted trees with balanced weights, at most ``max_iter`` rounds; of these, the ones up to the best AUC on the validation rows stay.

    Rounds end when ``patience`` of them in a row are no better than the best before. Spark fits a given number of rounds, so ``FIRST_ROUNDS``
    are fitted, then twice as many, until patience has run out; the same seed and rows give the same first trees, so each round is judged
    once, the new ones of a fit in one aggregate over the validation rows, and the model is the first trees up to the best round. Without
    validation rows, or where these lack a class, all rounds stay.

    Categories are encoded by out-of-fold means of the label, so neither they nor codes for them reach the driver; ``key`` names
    the columns that tell rows apart (by default all features do). A value unseen in training has the average.
    """
    train = _ready(train, label)
    key = [*numeric, *categorical] if key is None else key
    features = fit_features(train, numeric, categorical, scale=False, min_frequency=None, fill=UNKNOWN, label=label, key=key)
    inputs = [f"{n}{POOLED}" for n in features.numeric] + [f"{n}{POOLED}{ENCODED}" for n in features.categorical]
    assembler = VectorAssembler(inputCols=inputs, outputCol="features")
    weights, n_train = class_weight_constants(train, label, "w_max")
    tasks = max(1, min(train.sparkSession.sparkContext.defaultParallelism, n_train // TASK_ROWS))

    def assembled(df, fold=None):
        weight = class_weight(F.col(label), weights).alias("weight")
        return assembler.transform(features.transform(df, fold)).select(label, weight, "features")

    # boosting reads its input once per level and round: the assembled rows are written, in as many files as tasks are to share each level
    data = staged_lookup(assembled(train, fold_of(key)).repartition(tasks))
    held_out = None if validation is None else staged_lookup(assembled(_ready(validation, label)))

    def fitted(rounds):
        return GBTClassifier(featuresCol="features", labelCol=label, weightCol="weight", maxIter=rounds, stepSize=step, maxDepth=depth,
                             seed=seed, checkpointInterval=20).fit(data)

    rounds = max_iter if held_out is None else min(max_iter, FIRST_ROUNDS)
    known, best, judged = 0, None, []
    model = fitted(rounds)
    while held_out is not None:
        judged.append(staged_lookup(round_auc(by_round(staged_margins(model, held_out, label, known), after=known))))
        best = best_rounds(union_all(judged), patience=patience).first()
        if best is None or best["stopped"] or rounds == max_iter:
            break
        known, rounds = rounds, min(max_iter, 2 * rounds)
        model = fitted(rounds)
    if best:
        model = first_rounds(model, best["best_round"])
    elif rounds < max_iter:
        model = fitted(max_iter)
    info = {"kind": "trees", "label": label, "rounds": model.getNumTrees, "best_auc": best and best["best_auc"]}
    return SnapshotModel(features, PipelineModel(stages=[assembler, model]), info)


def feature_importance(model: SnapshotModel, spark: SparkSession) -> DataFrame:
    names = model.features.numeric + model.features.categorical
    values = model.pipeline.stages[-1].featureImportances.toArray()
    values = [*values, *[0.0] * (len(names) - len(values))]  # of a cut model they end with the last feature that a tree uses
    table = spark.createDataFrame([(n, float(v)) for n, v in zip(names, values, strict=True)],
                                  "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")
