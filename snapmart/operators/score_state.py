"""Scores as counts that can be merged: metrics and drift of any months without scoring them again.

A state has a row for each group and distinct score with its positives and negatives. States add up, so the state of several batches or
months is the union of theirs, summed. It is as large as there are different scores, and every metric is an aggregate over it.
"""

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.functions.numbers import score_key
from snapmart.operators.drift import BINS, psi
from snapmart.operators.metrics import THRESHOLD, monthly_of, summary_of
from snapmart.operators.ordering import running_sums

COUNTS = ("pos", "neg", "other")


def score_state(df: DataFrame, groups: list, y: str = "y", p: str = "p") -> DataFrame:
    """(groups, p, pos, neg, other) of scored rows, combined map-side; ``other`` counts rows whose label is neither 0 nor 1."""
    cells = {"pos": F.count_if(F.col(y) == 1), "neg": F.count_if(F.col(y) == 0)}
    known = F.coalesce(F.col(y).isin(0, 1), F.lit(False))
    return df.groupBy(*groups, F.col(p).alias("p")).agg(*[e.alias(n) for n, e in cells.items()], F.count_if(~known).alias("other"))


def merged(states: Iterable[DataFrame], groups: list) -> DataFrame:
    """One state of several."""
    return reduce(DataFrame.unionByName, states).groupBy(*groups, "p").agg(*[F.sum(c).alias(c) for c in COUNTS])


def state_metrics(state: DataFrame, groups: list, threshold: float = THRESHOLD) -> DataFrame:
    """All monitoring metrics of a state by ``groups``, which may be coarser than the state's own; as ``monthly_metrics`` gives of the rows."""
    labelled = state.filter((F.col("pos") > 0) | (F.col("neg") > 0))
    ranked = running_sums(labelled, groups, "p", {"pos": F.sum("pos"), "neg": F.sum("neg")}, key=score_key)
    return monthly_of(summary_of(ranked, groups, "p", threshold), groups)


def state_psi(state: DataFrame, side: Column, groups: list = (), bins: int = BINS) -> DataFrame:
    """Population stability index between the counts whose ``side`` is expected and actual, as ``psi`` gives of the rows."""
    counted = state.withColumn("_rows", sum((F.col(c) for c in COUNTS[1:]), F.col(COUNTS[0])))
    return psi(counted, side, groups, "p", bins, weight="_rows")
