"""Score histograms and the population stability index."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 10
EMPTY_SHARE = 0.0001
GRADES = [(0.1, "good"), (0.2, "attention")]


def bin_edges(bins: int = BINS) -> list:
    """Edges as multiples of the step, which is where a score such as 0.3 falls right below one."""
    step = 1.0 / bins
    return [i * step for i in range(bins)] + [1.0]


def bin_of(p: Column, bins: int = BINS) -> Column:
    """0-based bin in [0, 1]; the last bin is closed, and values outside belong to no bin."""
    edges = bin_edges(bins)
    inside = p.between(edges[0], edges[-1])
    reached = sum((F.when(p >= e, 1).otherwise(0) for e in edges[1:-1]), F.lit(0))
    return F.when(inside, reached)


def score_histogram(df: DataFrame, groups: list, p: str = "p", bins: int = BINS) -> DataFrame:
    """(groups, bin, n), with zero rows for empty bins.

    One aggregate per group counts all bins side by side, so no row is repeated and empty bins
    need no join.
    """
    counts = bin_counts(df, groups, p, bins)
    rows = F.array(*[F.struct(F.lit(i).alias("bin"), F.col(f"_b{i}").alias("n")) for i in range(bins)])
    return counts.select(*groups, F.inline(rows))


def bin_counts(df: DataFrame, groups: list, p: str = "p", bins: int = BINS) -> DataFrame:
    binned = df.withColumn("_bin", bin_of(F.col(p), bins))
    return binned.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("_all"), *[F.count_if(F.col("_bin") == i).alias(f"_b{i}") for i in range(bins)])


def psi(df: DataFrame, side: Column, groups: list = (), p: str = "p", bins: int = BINS, weight: str | None = None) -> DataFrame:
    """Population stability index between the rows whose ``side`` is expected and actual.

    Both histograms come from one aggregate over (group, bin) with no join. Rows with any other
    ``side`` are left out; the index is NULL where one side has no rows. A row counts ``weight`` times, once without one.
    """
    def rows(condition):
        return F.count_if(condition) if weight is None else F.coalesce(F.sum(F.when(condition, F.col(weight))), F.lit(0))

    groups = list(groups)
    data = (df.withColumn("_side", side).filter(F.col("_side").isin("expected", "actual"))
            .withColumn("_bin", bin_of(F.col(p), bins)))
    sides = ("expected", "actual")
    count = {s: rows(F.col("_side") == s).alias(f"_{s}") for s in sides}
    cells = {f"_{s}{i}": rows((F.col("_side") == s) & (F.col("_bin") == i)).alias(f"_{s}{i}")
             for s in sides for i in range(bins)}
    table = data.groupBy(*groups).agg(*count.values(), *cells.values())

    def part(s, i):
        x = F.try_divide(F.col(f"_{s}{i}").cast("double"), F.col(f"_{s}").cast("double"))
        return F.when(x == 0, F.lit(EMPTY_SHARE)).otherwise(x)

    terms = [(part("actual", i) - part("expected", i)) * F.ln(part("actual", i) / part("expected", i))
             for i in range(bins)]
    return table.select(*groups, sum(terms[1:], terms[0]).alias("psi"))


def psi_grade(value: Column, grades=GRADES, last: str = "drifted") -> Column:
    out = F.lit(last)
    for limit, name in reversed(grades):
        out = F.when(value < limit, name).otherwise(out)
    return F.when(value.isNotNull(), out)
