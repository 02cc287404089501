"""Row-level operators: missing-token filters, required columns, deduplication."""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from snapmart.functions.dates import ISO_DATE, parse_date
from snapmart.functions.text import any_missing_token, clean_header, null_if_missing, strip_text


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing column(s): {', '.join(missing)}")
    return df


def compute_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are evaluated once per row.

    Filters on a plain projected column are pushed below it with a copy of its expression; a
    one-element generator stops that where the expression is worth more than the filter.
    """
    return df.select("*", F.inline(F.array(F.struct(*[e.alias(n) for n, e in columns.items()]))))


def replace_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Replace one column by an expression that is evaluated once per row."""
    once = compute_once(df, {"_once": value})
    return once.select(*[F.col("_once").alias(c) if c == name else F.col(c) for c in df.columns])


def normalize_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_header(c) for c in df.columns])


def normalize_key(df: DataFrame, key: str) -> DataFrame:
    """Key as stripped text; rows without a key are dropped."""
    return replace_once(require_columns(df, key), key, strip_text(F.col(key))).filter(F.col(key) != "")


def parse_snapshot_date(df: DataFrame, col: str = "snapdate", fmt: str = ISO_DATE,
                        rejected: Observation | None = None) -> DataFrame:
    """Parse the snapshot date and drop rows where that fails.

    Pass an ``Observation`` to get ``n_rows`` and ``n_bad`` out of the same job.
    """
    df = replace_once(require_columns(df, col), col, parse_date(F.col(col), fmt))
    if rejected is not None:
        df = df.observe(rejected, F.count(F.lit(1)).alias("n_rows"),
                        F.count_if(F.col(col).isNull()).alias("n_bad"))
    return df.filter(F.col(col).isNotNull())


def drop_unknown_rows(df: DataFrame, skip=()) -> DataFrame:
    """Drop a row when any of its cells is missing; one filter, no shuffle.

    Text cells are compared with the missing tokens, typed cells only need to hold a value.
    """
    fields = [f for f in df.schema.fields if f.name not in skip]
    text = [F.col(f.name) for f in fields if f.dataType.simpleString() == "string"]
    typed = [f for f in fields if f.dataType.simpleString() != "string"]
    bad = [F.col(f.name).isNull() for f in typed]
    bad += [F.isnan(f.name) for f in typed if f.dataType.simpleString() in ("double", "float")]
    bad += [any_missing_token(text)] if text else []
    return df.filter(~reduce(or_, bad)) if bad else df


def sanitize_tokens(df: DataFrame, protected=()) -> DataFrame:
    """Cell-wise sibling of :func:`drop_unknown_rows`: missing tokens become NULL.

    Only text cells can hold a token; typed columns pass through untouched.
    """
    text = {f.name for f in df.schema.fields if f.dataType.simpleString() == "string"}
    return df.select(*[
        null_if_missing(F.col(c)).alias(c) if c in text and c not in protected else F.col(c)
        for c in df.columns])


def drop_value(df: DataFrame, col: str, value: str) -> DataFrame:
    """Drop rows whose text equals ``value`` in any case; NULL rows stay."""
    return df.filter(~F.lower(F.coalesce(F.col(col).cast("string"), F.lit("nan"))).eqNullSafe(F.lit(value)))


def keep_last(df: DataFrame, keys, order: str | Column) -> DataFrame:
    """Last row per key in ``order`` (unique per key).

    An aggregate instead of a row-number window: every map task already reduces a key to one
    row, so a key that holds a third of all rows costs one row per task in the shuffle. The
    row travels as one struct, so that NULL cells survive.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order_col = F.col(order) if isinstance(order, str) else order
    rest = [c for c in df.columns if c not in keys]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order_col).alias("_row"))
    return last.select(*[F.col(c) if c in keys else F.col("_row").getField(c).alias(c)
                         for c in df.columns])


def keep_unique(df: DataFrame, keys) -> DataFrame:
    """Only keys that occur exactly once; all members of a duplicate group go.

    One aggregate: a group of one is its own minimum, so no second pass or join is needed.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    rest = [c for c in df.columns if c not in keys]
    once = (df.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*rest)).alias("_row"))
            .filter(F.col("_n") == 1))
    return once.select(*[F.col(c) if c in keys else F.col("_row").getField(c).alias(c)
                         for c in df.columns])


def distinct_rows(df: DataFrame, order: str | None = None) -> DataFrame:
    """Repeated rows once; the ordinal takes no part and the smallest one of equal rows stays."""
    if order is None or order not in df.columns:
        return df.dropDuplicates()
    rest = [c for c in df.columns if c != order]
    return df.groupBy(*rest).agg(F.min(order).alias(order)).select(*df.columns)


def dedup_report(df: DataFrame, partition: str, key: str) -> DataFrame:
    """Rows before and after :func:`keep_unique` in each partition.

    Two aggregates: (partition, key) counts first, then their summary, so that neither a hot
    partition nor a hot key meets in one task as rows.
    """
    per_key = df.groupBy(partition, key).agg(F.count(F.lit(1)).alias("_n"))
    once = F.coalesce(F.sum(F.when(F.col("_n") == 1, F.col("_n"))), F.lit(0))
    report = per_key.groupBy(partition).agg(
        F.sum("_n").alias("rows_before"), once.alias("rows_after"))
    dropped = F.col("rows_before") - F.col("rows_after")
    return report.select(
        partition, "rows_before", "rows_after", dropped.alias("dropped"),
        F.when(dropped > 0, "duplicates removed").otherwise("no duplicates").alias("note"))


def union_all(frames) -> DataFrame:
    """Union by column name; a column missing on one side is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
