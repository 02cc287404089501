"""Election of the format of a date column from all of its values."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.functions.dates import DATE_FORMATS, ISO_DATE, format_number
from snapmart.operators.rows import compute_once, require_columns


def format_votes(df: DataFrame, columns, order: str | None = None) -> DataFrame:
    """(column, format, n, first): dates that a text column holds in each known format, and the smallest ordinal among them.

    One aggregate over the whole of all columns; map tasks send one row each, so neither a hot value nor the size matters.
    A value that looks like a date but is none (month 13) has no vote. Formats without a vote are left out; without an
    ordinal ``first`` is NULL.
    """
    columns = list(columns)
    numbered = compute_once(require_columns(df, *columns), {f"_no_{i}": format_number(F.col(c)) for i, c in enumerate(columns)})
    order_col = F.col(order) if order else F.lit(None).cast("bigint")

    def vote(column: str, no: Column, fmt: str, k: int) -> Column:
        return F.struct(F.lit(column).alias("column"), F.lit(fmt).alias("format"), F.count_if(no == k).alias("n"),
                        F.min(F.when(no == k, order_col)).alias("first"))

    votes = [vote(c, F.col(f"_no_{i}"), fmt, k) for i, c in enumerate(columns) for k, (_, fmt) in enumerate(DATE_FORMATS)]
    return numbered.agg(F.array(*votes).alias("_votes")).select(F.inline("_votes")).filter("n > 0")


def elect_formats(df: DataFrame, columns, order: str | None = None) -> dict[str, str]:
    """``{column: format}``: that of the smallest ordinal that has one; without an ordinal the most frequent one.

    Both depend on the rows alone, not on files or their order. Of equally frequent formats the first known one is taken, and ISO
    where no value is a date. The driver gets a row for each column and format.
    """
    order = order if order in df.columns else None
    listed = [fmt for _, fmt in DATE_FORMATS]
    elected: dict[str, str] = {}
    votes = format_votes(df, columns, order).collect() if columns else []
    for c in columns:
        own = [v for v in votes if v["column"] == c]
        dated = [v for v in own if v["first"] is not None]
        if dated:
            elected[c] = min(dated, key=lambda v: (v["first"], listed.index(v["format"])))["format"]
        else:
            elected[c] = min(own, key=lambda v: (-v["n"], listed.index(v["format"])))["format"] if own else ISO_DATE
    return elected


def elect_format(df: DataFrame, column: str = "snapdate", order: str | None = None) -> str:
    """Format of one date column; typed columns and missing ones need none, so they get ISO."""
    if column not in df.columns or df.schema[column].dataType.simpleString() != "string":
        return ISO_DATE
    return elect_formats(df, [column], order)[column]
