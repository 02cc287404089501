"""Months, time splits, stratified split and class weights."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MONITOR_MONTHS = 5
TRAIN_SHARE = 0.75
#: Leading hash digits of the ranges of each counting pass; the last one looks at whole hashes.
HASH_DIGITS = (4, 8, 32)


def month_calendar(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """All months from ``start`` to ``end`` of a one-row frame of dates."""
    first, last = F.trunc(start, "month"), F.trunc(end, "month")
    return bounds.select(F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("month"))


def missing_months(df: DataFrame, calendar: DataFrame, snap: str = "snapdate") -> DataFrame:
    """Months of the calendar without data."""
    present = df.select(F.trunc(snap, "month").alias("month")).distinct()
    return calendar.join(present, "month", "left_anti")


def snapshot_range(df: DataFrame, start: str, end: str, snap: str = "snapdate") -> DataFrame:
    """Inclusive date range; with literal bounds it prunes the snapshot partitions."""
    return df.filter(F.col(snap).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def latest_snapshot(df: DataFrame, snap: str = "snapdate") -> DataFrame:
    """Rows of the newest snapshot; its date is a scalar subquery, usable for partition pruning."""
    return df.filter(F.col(snap) == df.agg(F.max(snap)).scalar())


def with_month_columns(df: DataFrame, snap: str = "snapdate") -> DataFrame:
    return df.withColumns({
        "year": F.year(snap), "month": F.month(snap), "year_month": F.date_format(snap, "yyyy-MM")})


def month_range_label(snap: Column, ranges: dict[str, tuple[str, str]]) -> Column:
    """Name of the first (start month, end month) range, both inclusive, that holds the date."""
    month = F.trunc(snap, "month")
    out = F.lit(None).cast("string")
    for name, (start, end) in reversed(list(ranges.items())):
        out = F.when(month.between(F.lit(start).cast("date"), F.lit(end).cast("date")), name).otherwise(out)
    return out


def time_split(df: DataFrame, snap: str = "snapdate") -> DataFrame:
    """Add ``split``: the last five months monitor, three quarters of the rest train, others test.

    With fewer than five months, a third of them (at least one) is for monitoring. Only the
    distinct months (a calendar, at most a few thousand) are numbered; both cut dates reach
    the rows as one scalar subquery, so the frame is not shuffled.
    """
    months = df.select(F.trunc(snap, "month").alias("m")).filter(F.col("m").isNotNull()).distinct()
    numbered = months.select("m", F.row_number().over(Window.orderBy("m")).alias("i"),
                             F.count(F.lit(1)).over(Window.partitionBy()).alias("n"))
    monitored = F.when(F.col("n") >= MONITOR_MONTHS, F.lit(MONITOR_MONTHS)).otherwise(
        F.greatest(F.lit(1), F.floor(F.col("n") / 3)))
    rest = F.col("n") - monitored
    trained = F.floor(rest * F.lit(TRAIN_SHARE))
    cuts = numbered.agg(F.struct(
        F.max(F.when(F.col("i") <= trained, F.col("m"))).alias("train_to"),
        F.min(F.when(F.col("i") > rest, F.col("m"))).alias("monitor_from")).alias("c")).scalar()
    month = F.trunc(snap, "month")
    return (df.withColumn("_cuts", cuts)
            .withColumn("split", F.when(month >= F.col("_cuts")["monitor_from"], "monitor")
                        .when(month <= F.col("_cuts")["train_to"], "train")
                        .otherwise("test"))
            .drop("_cuts"))


def stratified_split(df: DataFrame, label: str, key, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``part`` (test/train): in each class, the ceil(share) of rows with the smallest key hashes.

    ``key`` names the column or columns that tell rows apart, for monthly rows customer and month; rows with equal keys
    stay on one side, so the share is exact for unique keys only. The split depends on the key alone, not
    on partitioning or row order. Instead of ranking a class in one task, the hash at the cut is fitted by counting:
    per leading digits, per more digits inside the range that holds the cut, then among the hashes left, each
    level of ranges evenly filled. One row per class reaches the driver in each step; the rows themselves are neither
    shuffled nor joined. Rows without a class are in train.
    """
    keys = [key] if isinstance(key, str) else list(key)
    hashed = F.md5(F.concat(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]), F.lit(f":{seed}")))
    counted = df.filter(F.col(label).isNotNull()).select(F.col(label).alias("_y"), hashed.alias("_h"))
    take = F.ceil(F.sum("_n").over(Window.partitionBy("_y")) * F.lit(test_share))
    left: dict = {}
    for level, digits in enumerate(HASH_DIGITS):
        part = F.substring("_h", 1, digits)
        counts = counted.groupBy("_y", part.alias("_range")).agg(F.count(F.lit(1)).alias("_n"))
        wanted = take if level == 0 else _per_class(left)
        upto = counts.withColumn("_upto", F.sum("_n").over(Window.partitionBy("_y").orderBy("_range"))).withColumn("_take", wanted)
        before = F.col("_upto") - F.col("_n")
        if digits == HASH_DIGITS[-1]:
            cuts = upto.filter(before < F.col("_take")).groupBy("_y").agg(F.max("_range").alias("_cut")).collect()
            break
        at = upto.filter((F.col("_upto") >= F.col("_take")) & (before < F.col("_take"))).collect()
        left = {r["_y"]: r["_take"] - r["_upto"] + r["_n"] for r in at}
        inside = F.lit(False)
        for r in at:
            inside = inside | ((F.col("_y") == r["_y"]) & (part == r["_range"]))
        counted = counted.filter(inside)
    is_test = F.lit(False)
    for r in cuts:
        is_test = is_test | ((F.col(label) == r["_y"]) & (hashed <= r["_cut"]))
    return df.withColumn("part", F.when(is_test, "test").otherwise("train"))


def _per_class(values: dict) -> Column:
    out = F.lit(None).cast("bigint")
    for y, n in values.items():
        out = F.when(F.col("_y") == y, F.lit(n)).otherwise(out)
    return out


def label_distribution(df: DataFrame, label: str) -> DataFrame:
    """(label, n, rate) per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("rate", F.col("n") / F.sum("n").over(Window.partitionBy()))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Two balanced weightings per class: n / (classes * n_class) and n_largest / n_class."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy()
    return counts.select(
        label, "n",
        (F.sum("n").over(w) / (F.count(F.lit(1)).over(w) * F.col("n"))).alias("w_balanced"),
        (F.max("n").over(w) / F.col("n")).alias("w_max"))


def class_weight_constants(df: DataFrame, label: str, kind: str) -> tuple[dict, int]:
    """Weight per class and the row count, for a model fit; one row per class reaches the driver."""
    fitted = class_weights(df, label).select(label, "n", kind).collect()
    return {r[label]: r[kind] for r in fitted}, sum(r["n"] for r in fitted)


def class_weight(label: Column, weights: dict) -> Column:
    out = F.lit(None).cast("double")
    for y, w in weights.items():
        out = F.when(label == y, F.lit(float(w))).otherwise(out)
    return out
