"""Choice of the boosting round: margins of an ensemble after every round, their AUC, and the round that patience stops at."""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapmart.functions.numbers import order_key
from snapmart.operators.metrics import auc_expr, ranked_scores

PATIENCE = 50
#: Rows whose margins a task holds for all rounds at once.
ROWS = 1024
_LEAF = re.compile(r"Predict: (\S+)")


def leaf_values(model: GBTClassificationModel) -> np.ndarray:
    """Weighted value of each leaf (column) of each tree (row), in the order of Spark's leaf indices; trees with fewer leaves end in zeros."""
    found = [[w * float(x) for x in _LEAF.findall(tree.toDebugString)] for tree, w in zip(model.trees, model.treeWeights, strict=True)]
    out = np.zeros((len(found), max(map(len, found), default=1)))
    for row, values in zip(out, found, strict=True):
        row[:len(values)] = values
    return out


def first_rounds(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model as it was after so many rounds: its first trees, which a fit of that number of rounds would make again."""
    sc = SparkContext.getOrCreate()
    tree = sc._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    trees, weights = sc._gateway.new_array(tree, rounds), sc._gateway.new_array(sc._jvm.double, rounds)
    for i, (fitted, weight) in enumerate(zip(model.trees[:rounds], model.treeWeights[:rounds], strict=True)):
        trees[i], weights[i] = fitted._java_obj, float(weight)
    cut = GBTClassificationModel(sc._jvm.org.apache.spark.ml.classification.GBTClassificationModel(model.uid, trees, weights))
    return cut.setFeaturesCol(model.getFeaturesCol())


def staged_margins(model: GBTClassificationModel, rows: DataFrame, label: str, after: int = 0) -> DataFrame:
    """(y, margins): the margin of each row after every round, those of the first ``after`` rounds left out. The model's probability is 1 / (1 + exp(-2 * margin))."""
    values = leaf_values(model)
    placed = model.transform(rows, {model.leafCol: "_leaf"}).select(F.col(label).cast("int").alias("y"), vector_to_array("_leaf").alias("_leaf"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(lo, ROWS) for lo in range(0, batch.num_rows, ROWS)):
                leaves = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(part.num_rows, len(values))
                margins = np.cumsum(values[np.arange(len(values)), leaves], axis=1)[:, after:]
                offsets = pa.array(np.arange(len(margins) + 1, dtype=np.int32) * margins.shape[1])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(offsets, pa.array(margins.ravel()))], ["y", "margins"])

    return placed.mapInArrow(run, "y int, margins array<double>")


def by_round(margins: DataFrame, groups: list = (), after: int = 0) -> DataFrame:
    """(groups, round, y, margin) of (groups, y, margins) rows whose margins begin after so many rounds."""
    return margins.select(*groups, "y", F.posexplode("margins").alias("_k", "margin")).select(*groups, (F.col("_k") + 1 + after).alias("round"), "y", "margin")


def round_auc(staged: DataFrame, groups: list = ()) -> DataFrame:
    """(groups, round, auc) of (groups, round, y, margin) rows: one grouped aggregate for all rounds.

    Equal margins of a round are combined map-side; early rounds have few. NULL where a class is missing.
    """
    by = [*groups, "round"]
    both = (F.max("pos_total") > 0) & (F.max("neg_total") > 0)
    return ranked_scores(staged, by, "y", "margin", key=order_key).groupBy(*by).agg(F.when(both, auc_expr()).alias("auc"))


def best_rounds(rounds: DataFrame, groups: list = (), patience: int = PATIENCE) -> DataFrame:
    """(groups, best_round, best_auc, last_round, stopped) of (groups, round, auc) rows.

    Rounds are read in order until ``patience`` of them in a row are no better than the best before; ``last_round`` is the one at which that
    shows, and ``stopped`` is false where the rounds end before. Only a larger AUC is better, so of equal ones the first counts. The
    windows hold a row for each round of a group.
    """
    ordered = Window.partitionBy(*groups).orderBy("round")
    before = F.max("auc").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    ends = F.max("round").over(Window.partitionBy(*groups))
    better = (rounds.select(*groups, "round", "auc", before.alias("_before"), ends.alias("_ends"))
              .filter(F.col("auc").isNotNull() & (F.col("_before").isNull() | (F.col("auc") > F.col("_before")))))
    following = F.lead("round").over(ordered)
    final = better.withColumn("_next", F.coalesce(following, F.col("_ends") + 1 + patience)).filter(F.col("_next") - F.col("round") > patience)
    first = F.min(F.struct("round", "auc", F.least(F.col("round") + patience, F.col("_ends")).alias("last"), (F.col("round") + patience <= F.col("_ends")).alias("stopped")))
    best = final.groupBy(*groups).agg(first.alias("_b")) if groups else final.agg(first.alias("_b")).filter("_b IS NOT NULL")
    return best.select(*groups, F.col("_b.round").alias("best_round"), F.col("_b.auc").alias("best_auc"), F.col("_b.last").alias("last_round"), F.col("_b.stopped").alias("stopped"))
