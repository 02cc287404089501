"""Binary classification metrics per group, for all models and months in one job.

Input is a scores frame with a 0/1 label, a score and any grouping columns. Everything is an
aggregate over (group, distinct score) rows, so a group may hold any share of the data.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.functions.numbers import score_key, share
from snapmart.operators.ordering import running_sums

THRESHOLD = 0.5
CLIP = 1e-7

RANKING = ["auc", "average_precision", "ks"]
THRESHOLDED = ["f1", "precision", "recall"]
CALIBRATION = ["brier", "logloss", "pred_mean", "pred_std", "positives", "negatives", "n"]


def _pos(y):
    return F.sum((F.col(y) == 1).cast("bigint"))


def _neg(y):
    return F.sum((F.col(y) == 0).cast("bigint"))


def ranked_scores(df: DataFrame, groups: list, y: str = "y", p: str = "p", key=score_key) -> DataFrame:
    """Distinct scores per group with pos, neg, their sums over smaller scores and totals; ``key`` parts the scores into ranges."""
    return running_sums(df, groups, p, {"pos": _pos(y), "neg": _neg(y)}, key=key)


def auc_expr() -> Column:
    """Share of (positive, negative) pairs in the right order; ties count one half."""
    below = F.col("neg_before").cast("double") + F.col("neg") / 2.0
    pairs = F.max("pos_total").cast("double") * F.max("neg_total")
    return F.sum(F.col("pos") * below) / F.nullif(pairs, F.lit(0.0))


def average_precision_expr() -> Column:
    """Sum of precision times recall step over descending distinct scores."""
    tp = (F.col("pos_total") - F.col("pos_before")).cast("double")
    fp = F.col("neg_total") - F.col("neg_before")
    return F.sum(F.col("pos") * tp / (tp + fp)) / F.nullif(F.max("pos_total"), F.lit(0).cast("bigint"))


def ks_expr() -> Column:
    """Largest distance of the two score distributions, taken after each distinct score."""
    up_pos = (F.col("pos_before") + F.col("pos")) / F.greatest(F.lit(1), F.col("pos_total"))
    up_neg = (F.col("neg_before") + F.col("neg")) / F.greatest(F.lit(1), F.col("neg_total"))
    return F.max(F.abs(up_pos - up_neg))


RANKING_EXPRS = {"auc": auc_expr, "average_precision": average_precision_expr, "ks": ks_expr}


def ranking_metrics(df: DataFrame, groups: list, names=RANKING, y: str = "y", p: str = "p") -> DataFrame:
    """Tie-free ranking metrics; NULL where a group has a single class."""
    both = (F.max("pos_total") > 0) & (F.max("neg_total") > 0)
    return ranked_scores(df, groups, y, p).groupBy(*groups).agg(
        *[F.when(both, RANKING_EXPRS[n]()).alias(n) for n in names])


def _cells(y, p, thr):
    hit = F.col(p) >= thr
    return {"tn": F.count_if((F.col(y) == 0) & ~hit), "fp": F.count_if((F.col(y) == 0) & hit),
            "fn": F.count_if((F.col(y) == 1) & ~hit), "tp": F.count_if((F.col(y) == 1) & hit)}


def confusion_matrix(df: DataFrame, groups: list, y="y", p="p", threshold=THRESHOLD) -> DataFrame:
    return df.groupBy(*groups).agg(*[e.alias(n) for n, e in _cells(y, p, threshold).items()])


def threshold_columns() -> dict[str, Column]:
    """accuracy, precision, recall and f1 of tn, fp, fn, tp columns; empty denominators give 0."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return {"accuracy": share(tp + tn, tp + tn + fp + fn), "precision": share(tp, tp + fp),
            "recall": share(tp, tp + fn), "f1": share(2 * tp, 2 * tp + fp + fn)}


def threshold_metrics(df: DataFrame, groups: list, y="y", p="p", threshold=THRESHOLD) -> DataFrame:
    cells = confusion_matrix(df, groups, y, p, threshold)
    return cells.select(*groups, *[e.alias(n) for n, e in threshold_columns().items()])


def classification_report(df: DataFrame, groups: list, y="y", p="p", threshold=THRESHOLD) -> DataFrame:
    """precision, recall, f1 and support per class, plus accuracy, macro and weighted averages."""
    c = confusion_matrix(df, groups, y, p, threshold)
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp

    def line(label, precision, recall, f1, support):
        return F.struct(F.lit(label).alias("label"), precision.alias("precision"), recall.alias("recall"),
                        f1.alias("f1"), support.alias("support"))

    neg = (share(tn, tn + fn), share(tn, tn + fp), share(2 * tn, 2 * tn + fn + fp))
    pos = (share(tp, tp + fp), share(tp, tp + fn), share(2 * tp, 2 * tp + fp + fn))
    acc = share(tp + tn, n)
    macro = [(a + b) / 2.0 for a, b in zip(neg, pos)]
    weighted = [share(a * (tn + fp) + b * (fn + tp), n) for a, b in zip(neg, pos)]
    rows = F.array(line("0", *neg, tn + fp), line("1", *pos, fn + tp), line("accuracy", acc, acc, acc, n),
                   line("macro avg", *macro, n), line("weighted avg", *weighted, n))
    return c.select(*groups, F.inline(rows))


def _calibration(p, pos, neg):
    """Aggregates over rows that stand for ``pos`` positives and ``neg`` negatives at score p."""
    n = pos + neg
    q = F.least(F.greatest(p, F.lit(CLIP)), F.lit(1 - CLIP))
    total = F.sum(n)
    mean = F.sum(p * n) / total
    return {
        "brier": F.sum(pos * (1 - p) * (1 - p) + neg * p * p) / total,
        "logloss": -F.sum(pos * F.ln(q) + neg * F.ln(1 - q)) / total,
        "pred_mean": mean,
        "pred_std": F.sqrt(F.greatest(F.sum(p * p * n) / total - mean * mean, F.lit(0.0))),
        "positives": F.sum(pos),
        "negatives": F.sum(neg),
        "n": total,
    }


def calibration_metrics(df: DataFrame, groups: list, y="y", p="p") -> DataFrame:
    """Brier score, log loss, score mean and deviation and counts."""
    pos, neg = (F.col(y) == 1).cast("bigint"), (F.col(y) == 0).cast("bigint")
    exprs = _calibration(F.col(p), pos, neg)
    exprs["pred_std"] = F.stddev_pop(p)
    return df.groupBy(*groups).agg(*[e.alias(n) for n, e in exprs.items()])


def score_summary(df: DataFrame, groups: list, y="y", p="p", threshold=THRESHOLD) -> DataFrame:
    """Ranking metrics, confusion matrix and calibration per group out of one shuffle of the scores.

    After the rows of equal scores are combined, every metric is an aggregate over distinct
    scores.
    """
    return summary_of(ranked_scores(df, groups, y, p), groups, p, threshold)


def summary_of(ranked: DataFrame, groups: list, p="p", threshold=THRESHOLD) -> DataFrame:
    """``score_summary`` of distinct scores with their counts and running sums."""
    hit = F.col(p) >= threshold
    cells = {"tn": F.when(~hit, F.col("neg")), "fp": F.when(hit, F.col("neg")),
             "fn": F.when(~hit, F.col("pos")), "tp": F.when(hit, F.col("pos"))}
    both = (F.max("pos_total") > 0) & (F.max("neg_total") > 0)
    calibration = _calibration(F.col(p), F.col("pos"), F.col("neg"))
    return ranked.groupBy(*groups).agg(
        *[F.when(both, RANKING_EXPRS[n]()).alias(n) for n in RANKING],
        *[F.coalesce(F.sum(e), F.lit(0)).alias(n) for n, e in cells.items()],
        *[e.alias(n) for n, e in calibration.items()])


def monthly_metrics(df: DataFrame, groups: list, y="y", p="p", threshold=THRESHOLD) -> DataFrame:
    """All monitoring metrics; ranking and threshold metrics are NULL in a group with a single class."""
    return monthly_of(score_summary(df, groups, y, p, threshold), groups)


def monthly_of(summary: DataFrame, groups: list) -> DataFrame:
    both = (F.col("positives") > 0) & (F.col("negatives") > 0)
    at_threshold = threshold_columns()
    return summary.select(
        *groups, *RANKING,
        *[F.when(both, at_threshold[n]).alias(n) for n in THRESHOLDED],
        at_threshold["accuracy"].alias("accuracy"), *CALIBRATION)


def metrics_long(df: DataFrame, groups: list, names: dict[str, str]) -> DataFrame:
    """(groups, Metric, Value) rows; ``names`` maps metric columns to their display names."""
    wide = df.select(*groups, *[F.col(c).cast("double").alias(n) for c, n in names.items()])
    return wide.unpivot(groups, list(names.values()), "Metric", "Value")


def prediction_summary(df: DataFrame, groups: list, p="p", threshold=THRESHOLD) -> DataFrame:
    """Rows predicted 0 and 1 and the mean score."""
    return df.groupBy(*groups).agg(
        F.count_if(F.col(p) < threshold).alias("n_0"), F.count_if(F.col(p) >= threshold).alias("n_1"),
        F.avg(p).alias("pred_mean"))
