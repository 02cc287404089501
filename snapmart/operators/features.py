"""Calendar features, imputation, scaling, category vocabularies."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart.functions.dates import day_number, quarter_number, weekday_number
from snapmart.operators.lookup import lookup_join, staged_lookup
from snapmart.operators.ordering import exact_medians, long_values, modes
from snapmart.operators.schema import CALENDAR_NAMES, numeric_columns, text_columns

UNKNOWN = "Unknown"
INFREQUENT = "__infrequent__"


def date_columns(df: DataFrame) -> list:
    """Date-typed columns with ``date`` or ``time`` in their name."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
            and f.name not in CALENDAR_NAMES
            and ("date" in f.name.lower() or "time" in f.name.lower())]


def calendar_features(df: DataFrame, columns=None) -> DataFrame:
    """Replace each date column by its day, weekday (Monday = 0) and quarter."""
    columns = date_columns(df) if columns is None else list(columns)
    parts = {"day": day_number, "dayofweek": weekday_number, "quarter": quarter_number}
    return df.withColumns({
        f"{c}_{name}": part(F.col(c)) for c in columns for name, part in parts.items()}).drop(*columns)


def impute_median(df: DataFrame, columns, fit_on: DataFrame | None = None) -> DataFrame:
    """Fill NULL with the exact median of ``fit_on`` (default: the frame itself)."""
    fitted = exact_medians(df if fit_on is None else fit_on, list(columns))
    return df.withColumns({
        c: F.coalesce(F.col(c).cast("double"), F.lit(m).cast("double")) for c, m in fitted.items()})


def impute_mode(df: DataFrame, columns, fit_on: DataFrame | None = None) -> DataFrame:
    """Fill NULL with the most frequent value of ``fit_on``, the smallest of tied ones."""
    fitted = modes(df if fit_on is None else fit_on, columns)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast("string")) for c, v in fitted.items()})


def deviations(df: DataFrame, columns) -> dict:
    """``{column: population deviation}`` in one aggregate; 1 for a constant column."""
    row = df.agg(*[F.stddev_pop(c).alias(c) for c in columns]).first()
    return {c: row[c] or 1.0 for c in columns}


def scale_by_std(df: DataFrame, columns, fit_on: DataFrame | None = None) -> DataFrame:
    """Divide by the population deviation; no centring."""
    fitted = deviations(df if fit_on is None else fit_on, list(columns))
    return df.withColumns({c: F.col(c) / F.lit(s) for c, s in fitted.items()})


def fill_missing(df: DataFrame, fit_on: DataFrame | None = None, exclude=()) -> DataFrame:
    """Median for numeric columns and ``Unknown`` for text."""
    numbers = numeric_columns(df, exclude)
    out = impute_median(df, numbers, fit_on) if numbers else df
    text = [c for c in text_columns(df, exclude)]
    return out.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)) for c in text})


def category_vocabulary(df: DataFrame, columns, min_frequency: int) -> DataFrame:
    """(column, value, n, pooled): every category, those below ``min_frequency`` pooled into one.

    The long tail stays a table, so that a rare category can be told from one never seen.
    """
    counts = (long_values(df, {c: F.col(c).cast("string") for c in columns})
              .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    return counts.withColumn("pooled", F.when(F.col("n") >= min_frequency, F.col("value")).otherwise(INFREQUENT))


def apply_vocabulary(df: DataFrame, columns, vocabulary: DataFrame, suffix: str = "") -> DataFrame:
    """Pooled category per column; a value outside the vocabulary becomes NULL."""
    out = df
    for c in columns:
        part = vocabulary.filter(F.col("column") == c).select(
            F.col("value").alias("_value"), F.col("pooled").alias("_pooled"))
        out = lookup_join(out.withColumn("_value", F.col(c).cast("string")), part, ["_value"])
        out = out.withColumn(f"{c}{suffix}", F.col("_pooled")).drop("_value", "_pooled")
    return out


def pool_rare_categories(df: DataFrame, columns, min_frequency: int = 10) -> DataFrame:
    return apply_vocabulary(df, columns, staged_lookup(category_vocabulary(df, columns, min_frequency))).select(*df.columns)
