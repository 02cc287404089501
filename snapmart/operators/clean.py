"""Cleaners for the four feature tables."""

from dataclasses import dataclass
from math import floor, isfinite

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.functions.dates import ISO_DATE, parse_date
from snapmart.functions.numbers import cap_at, null_nan, parse_number, round_half_even
from snapmart.operators.fuzzy import DEMOGRAPHIC_SPECS, canonicalize
from snapmart.operators.ordering import long_values, quantiles_of_counts
from snapmart.operators.rows import compute_once, distinct_rows, drop_value, normalize_headers, normalize_key

ORDER = "ord_"
QUARTILES = {"q1": 0.25, "q3": 0.75}


@dataclass(frozen=True)
class NumericSpec:
    """Cleaning policy of one numeric text column.

    negative: "zero", "null" or "keep" (kept values take no part in the fence)
    whole:    None, "floor" or "round" for values with a fraction
    outlier:  "clip" to the upper fence or "null"
    """

    negative: str = "zero"
    whole: str | None = None
    outlier: str = "clip"
    iqr_k: float = 3.0
    digits: int | None = 2
    outlier_flag: str = "was_outlier_high"

    def __post_init__(self):
        if self.negative not in ("zero", "null", "keep"):
            raise ValueError("negative must be 'zero', 'null' or 'keep'")
        if self.whole not in (None, "floor", "round"):
            raise ValueError("whole must be None, 'floor' or 'round'")
        if self.outlier not in ("clip", "null"):
            raise ValueError("outlier must be 'clip' or 'null'")

    def base(self, x: Column) -> Column:
        """Parsed value after the negative and fraction policies."""
        if self.negative == "zero":
            x = F.when(x < 0, F.lit(0.0)).otherwise(x)
        elif self.negative == "null":
            x = F.when(x >= 0, x)
        if self.whole == "floor":
            x = F.floor(x).cast("double")
        elif self.whole == "round":
            x = F.rint(x)
        return x

    def fenced(self, x: Column) -> Column:
        """Values that take part in the quartiles."""
        return F.when(x >= 0, x)


MONTHLY_CHARGES = NumericSpec(outlier_flag="was_outlier")
REFUND_CHARGES = NumericSpec(negative="keep", outlier_flag="was_outlier")
DATA_USAGE = NumericSpec(negative="null", outlier="null")
APP_LOGINS = NumericSpec(whole="floor", outlier="null", digits=None)

FINANCIAL_SPECS = {
    "MonthlyCharges": MONTHLY_CHARGES,
    "AverageDataUsage": DATA_USAGE,
    "AppLoginFrequency": APP_LOGINS,
}
FINANCIAL_DROP = ("tenure", "LatePaymentCount")
FINANCIAL_KEEP = ("MonthlyCharges", "AverageDataUsage", "AppLoginFrequency",
                  "CustomerSatisfactionScore", "customerID")


def iqr_fences(df: DataFrame, specs: dict[str, NumericSpec]) -> dict:
    """Fit ``{column: {"q1", "q3", "upper"}}`` of all fenced columns together.

    Equal cells are combined map-side before they are parsed, so a text is parsed once, after the shuffle.
    """
    cells = long_values(df, {c: F.col(c).cast("string") for c in specs}, values="text").groupBy("column", "text").agg(F.count(F.lit(1)).alias("_n"))
    parsed = compute_once(cells, {"_num": parse_number(F.col("text"))})
    value = F.lit(None).cast("double")
    for c, s in specs.items():
        value = F.when(F.col("column") == c, s.fenced(s.base(F.col("_num")))).otherwise(value)
    counted = parsed.select("column", null_nan(value).alias("value"), "_n")
    return {c: q | {"upper": q["q3"] + specs[c].iqr_k * max(q["q3"] - q["q1"], 0.0)}
            for c, q in quantiles_of_counts(counted, QUARTILES).items()}


def clean_numeric(df: DataFrame, specs: dict[str, NumericSpec], fences: dict | None = None) -> DataFrame:
    """Clean numeric text columns, keeping a raw copy and quality flags of each.

    The upper fences are fitted constants (pass ``fences`` to reuse earlier ones); the frame
    itself is then read once and not shuffled. A column without values has no fence.
    """
    specs = {c: s for c, s in specs.items() if c in df.columns}
    if not specs:
        return df
    fences = iqr_fences(df, specs) if fences is None else fences
    extra = {f"{c}_raw": F.col(c) for c in specs if f"{c}_raw" not in df.columns}
    out = compute_once(df.withColumns(extra), {f"_num_{c}": parse_number(F.col(c)) for c in specs})
    cols = {}
    for c, s in specs.items():
        num = F.col(f"_num_{c}")
        x = s.base(num)
        fence = fences.get(c, {}).get("upper", float("inf"))
        upper = F.lit(float(floor(fence)) if s.whole and isfinite(fence) else fence)
        high = F.coalesce(x > F.lit(fence), F.lit(False))
        cols[f"{c}_was_negative"] = F.coalesce(num < 0, F.lit(False))
        if s.whole:
            cols[f"{c}_was_fractional"] = F.coalesce(num.isNotNull() & (num >= 0) & (num % 1 != 0), F.lit(False))
        cols[f"{c}_{s.outlier_flag}"] = high
        if s.negative == "keep":
            cols[f"{c}_refund"] = F.when(num < 0, F.abs(num)).otherwise(F.lit(0.0))
            cols[f"{c}_paid_pos"] = F.when(num < 0, F.lit(0.0)).otherwise(num)
        value = cap_at(x, upper) if s.outlier == "clip" else F.when(~high, x)
        if s.digits is not None:
            value = round_half_even(value, s.digits)
        cols[c] = value.cast("bigint") if s.whole else value
    return out.withColumns(cols).drop(*[f"_num_{c}" for c in specs])


def clean_financial(df: DataFrame, key: str = "customerID", order: str | None = None, fences: dict | None = None) -> DataFrame:
    """Clean the numeric columns over all rows, by ``fences`` fitted earlier if given, then drop rows without a key."""
    df = normalize_headers(df).drop(*FINANCIAL_DROP)
    keep = [c for c in FINANCIAL_KEEP if c in df.columns] + ([order] if order else [])
    return normalize_key(clean_numeric(df, FINANCIAL_SPECS, fences), key).select(*keep)


def clean_demographic(df: DataFrame, key: str = "customerID", specs=None, fmt: str = ISO_DATE, dictionary: DataFrame | None = None) -> DataFrame:
    df = _dated(normalize_key(normalize_headers(df), key), fmt)
    return canonicalize(df, DEMOGRAPHIC_SPECS if specs is None else specs, dictionary)


def _dated(df: DataFrame, fmt: str) -> DataFrame:
    return df.withColumn("snapdate", parse_date(F.col("snapdate"), fmt)) if "snapdate" in df.columns else df


def clean_contract(df: DataFrame, key: str = "customerID", fmt: str = ISO_DATE, order: str = ORDER) -> DataFrame:
    """Drop unknown contracts, parse the date and remove rows that repeat in all but their ordinal."""
    df = normalize_key(normalize_headers(df), key)
    if "Contract" in df.columns:
        df = drop_value(df, "Contract", "unknown")
    return distinct_rows(_dated(df, fmt), order)


def clean_service(df: DataFrame, key: str = "customerID", fmt: str = ISO_DATE, order: str = ORDER) -> DataFrame:
    """Parse the date, write missing text as empty text and remove rows that repeat in all but their ordinal."""
    df = _dated(normalize_key(normalize_headers(df), key), fmt)
    return distinct_rows(df.na.fill(""), order)
