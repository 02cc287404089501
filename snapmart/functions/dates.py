"""Date parsing and calendar columns."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_DATE = "yyyy-MM-dd"

# formats tried, in this order, when the format has to be read off the first value
DATE_FORMATS = [
    (re.compile(r"^\d{4}-\d{2}-\d{2}$"), "yyyy-MM-dd"),
    (re.compile(r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}$"), "yyyy-MM-dd['T'][ ]HH:mm:ss"),
    (re.compile(r"^\d{4}/\d{2}/\d{2}$"), "yyyy/MM/dd"),
    (re.compile(r"^\d{4}_\d{2}_\d{2}$"), "yyyy_MM_dd"),
    (re.compile(r"^\d{8}$"), "yyyyMMdd"),
    (re.compile(r"^\d{1,2}/\d{1,2}/\d{4}$"), "M/d/yyyy"),
]


def parse_date(c: Column, fmt: str = ISO_DATE) -> Column:
    """Date of a text cell in one format; every other text becomes NULL.

    ISO dates take a shape test and a cast, which is several times faster on bad cells than
    a failing formatter.
    """
    if fmt == ISO_DATE:
        return F.nullif(F.regexp_extract(c.cast("string"), r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", 0), F.lit("")).try_cast("date")
    return F.try_to_date(c.cast("string"), fmt)


def date_format_of(value: str):
    """Format that fits one sample value, or None."""
    return next((fmt for pattern, fmt in DATE_FORMATS if pattern.match(value.strip())), None)


def format_number(c: Column) -> Column:
    """Place in ``DATE_FORMATS`` of the first format in which a text is a date; NULL where there is none."""
    text = c.cast("string")
    fits = [text.rlike(shape.pattern) & parse_date(text, fmt).isNotNull() for shape, fmt in DATE_FORMATS]
    return F.coalesce(*[F.when(fit, F.lit(i)) for i, fit in enumerate(fits)])


def date_from_name(name: Column) -> Column:
    """Date written as YYYY_MM_DD inside a file name; NULL when there is none or it is invalid."""
    return parse_date(F.regexp_extract(name, r"(\d{4}_\d{2}_\d{2})", 1), "yyyy_MM_dd")


def month_of(c: Column) -> Column:
    """First day of the month."""
    return F.trunc(c, "month")


def year_month(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def day_number(c: Column) -> Column:
    return F.day(c)


def weekday_number(c: Column) -> Column:
    """Monday = 0."""
    return F.weekday(c)


def quarter_number(c: Column) -> Column:
    return F.quarter(c)
