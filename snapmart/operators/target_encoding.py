"""Categories as smoothed label means, taken out of fold on the rows they are fitted on."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.operators.lookup import lookup_join, staged_lookup

FOLDS = 5
#: Rows of the average label that every category is taken to have had besides its own.
SMOOTHING = 10.0


def fold_of(keys) -> Column:
    """Fold (from 0) of a row by a hash of its key columns, so it hangs on neither partitions nor order; NULL counts as text."""
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys])
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % FOLDS).cast("int")


@dataclass
class TargetEncoding:
    """``table`` has (column, value, encoded) with a list: the mean over all rows, then without each fold; ``prior`` is the list for values never seen."""

    columns: list
    prior: list
    table: DataFrame

    def transform(self, df: DataFrame, fold: Column | None = None, suffix: str = "") -> DataFrame:
        """Each column of ``columns`` as its encoded value in ``<column><suffix>``.

        Rows that were fitted on pass their ``fold``, which takes no part in their values; other rows take all folds. The values come by
        joins with the table, which are broadcast or shuffled by its bytes, and a hot value is split by adaptive execution.
        """
        place = F.lit(0) if fold is None else fold + 1
        out = df.withColumn("_place", place)
        for c in self.columns:
            part = self.table.filter(F.col("column") == c).select(F.col("value").alias("_value"), F.col("encoded").alias("_encoded"))
            out = lookup_join(out.withColumn("_value", F.col(c).cast("string")), part, ["_value"])
            prior = F.array(*[F.lit(float(p)) for p in self.prior])
            out = out.withColumn(f"{c}{suffix}", F.get(F.coalesce("_encoded", prior), F.col("_place"))).drop("_value", "_encoded")
        return out.drop("_place")


def fit_target_encoding(train: DataFrame, label: str, columns, key, smoothing: float = SMOOTHING) -> TargetEncoding:
    """Encoding of ``columns`` by the mean of a 0/1 label, fitted on ``train``; ``key`` tells its rows apart.

    Counts by (column, value, fold) are combined map-side, so a value that a third of all rows share is a few rows in the shuffle. The table
    has a row for each value and stays a table however many there are; the driver gets the totals of the folds alone. A value's mean
    is drawn to the average label by ``smoothing`` rows; values met in one fold only have the average in that fold. Rows
    whose label is NULL take no part; a NULL value is no category.
    """
    columns = list(columns)
    rows = train.filter(F.col(label).isNotNull()).withColumn("_fold", fold_of(key))
    sums = {r["_fold"]: (r["n"], r["s"]) for r in rows.groupBy("_fold").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("double")).alias("s")).collect()}
    n, s = (sum(x[i] for x in sums.values()) for i in (0, 1))
    left = [(n, s)] + [(n - sums.get(k, (0, 0.0))[0], s - sums.get(k, (0, 0.0))[1]) for k in range(FOLDS)]
    prior = [b / a if a else (s / n if n else 0.0) for a, b in left]
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    long = rows.select("_fold", F.col(label).cast("double").alias("_y"), F.inline(pairs)).filter(F.col("value").isNotNull())
    folds = long.groupBy("column", "value", "_fold").agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("s"))
    outside = [F.lit(True)] + [F.col("_fold") != k for k in range(FOLDS)]

    def mean(keep: Column, p: float) -> Column:
        count, total = (F.coalesce(F.sum(F.when(keep, F.col(c))), F.lit(0)) for c in ("n", "s"))
        return (total + F.lit(smoothing * p)) / (count + F.lit(smoothing))

    encoded = F.array(*[mean(keep, p) for keep, p in zip(outside, prior, strict=True)])
    return TargetEncoding(columns, prior, staged_lookup(folds.groupBy("column", "value").agg(encoded.alias("encoded"))))
