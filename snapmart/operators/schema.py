"""Schema-driven choices: column resolution, type split, alignment, profiles."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart.functions.numbers import parse_number

# --- fixed values: column names looked for, exact case, in this order ----------------------
LABEL_NAMES = ["Churn", "label", "churn", "is_churn", "target", "y"]
KEY_NAMES = ["customerID", "Customer_ID", "customer_id", "CUSTOMER_ID", "cust_id",
             "CustomerId", "CustomerID", "id", "ID"]
CALENDAR_NAMES = ["year", "month", "year_month"]


def first_column(df: DataFrame, candidates) -> str | None:
    return next((c for c in candidates if c in df.columns), None)


def label_column(df: DataFrame, candidates=LABEL_NAMES) -> str | None:
    """Label by exact name, then by the name ``churn`` in any case."""
    return first_column(df, candidates) or next((c for c in df.columns if c.lower() == "churn"), None)


def numeric_columns(df: DataFrame, exclude=()) -> list:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def text_columns(df: DataFrame, exclude=()) -> list:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.StringType, T.BooleanType)) and f.name not in exclude]


def binary_column_scan(df: DataFrame, columns=None) -> DataFrame:
    """(column, is_binary) for numeric columns: are all its values 0 or 1? One aggregate for all."""
    columns = numeric_columns(df) if columns is None else list(columns)
    checks = df.agg(*[F.coalesce(F.bool_and(F.col(c).isin(0, 1)), F.lit(True)).alias(c) for c in columns])
    return _as_rows(checks, columns, "is_binary")


def is_yes_no(df: DataFrame, col: str) -> DataFrame:
    """One row: are all values of a text column yes or no (lower or title case)?"""
    return df.agg(F.coalesce(F.bool_and(F.col(col).isin("Yes", "No", "yes", "no")), F.lit(True)).alias("is_yes_no"))


def null_profile(df: DataFrame) -> DataFrame:
    """(column, n_null) of every column in one aggregate."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return _as_rows(counts, df.columns, "n_null")


def numeric_ratio(df: DataFrame, columns, threshold: float = 0.9) -> DataFrame:
    """(column, ratio, mostly_numeric): share of non-null cells that parse as numbers."""
    ratios = df.agg(*[
        F.avg(F.when(F.col(c).isNotNull(), parse_number(F.col(c)).isNotNull().cast("int"))).alias(c)
        for c in columns])
    return (_as_rows(ratios, columns, "ratio")
            .withColumn("mostly_numeric", F.coalesce(F.col("ratio") >= threshold, F.lit(False))))


def cast_numeric_text(df: DataFrame, exclude=()) -> DataFrame:
    """Text columns whose cells all parse as numbers become doubles (one aggregate for all).

    Restores the types of a table whose columns were read as text.
    """
    columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]
    if not columns:
        return df
    parsed = {c: parse_number(F.col(c)) for c in columns}
    found = df.agg(*[
        ((F.count(c) > 0) & (F.count(c) == F.count(e))).alias(c) for c, e in parsed.items()]).first()
    return df.withColumns({c: parsed[c] for c in columns if found[c]})


def _as_rows(one_row: DataFrame, columns, value: str) -> DataFrame:
    return one_row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias(value)) for c in columns])))


def align_to_schema(df: DataFrame, schema: T.StructType, fill=None) -> DataFrame:
    """Exactly the columns of ``schema`` in its order; a missing one holds ``fill``.

    ``fill`` is cast to the column type, so NULL suits an imputing model and 0 a tree model.
    """
    def column(f: T.StructField) -> Column:
        if f.name in df.columns:
            return F.col(f.name).cast(f.dataType).alias(f.name)
        return F.lit(fill).cast(f.dataType).alias(f.name)
    return df.select(*[column(f) for f in schema.fields])


def numeric_by_name(df: DataFrame, exclude=()) -> DataFrame:
    """Numeric columns sorted by name: the fallback where no training schema is known."""
    return df.select(*sorted(numeric_columns(df, exclude)))
