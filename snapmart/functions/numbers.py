"""Tolerant number parsing, rounding and order-preserving cell keys."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# A guard is needed because a plain cast reads "12f" and "12d" as numbers and "nan" as NaN. The
# number is cut out of its white space in the same match, so the text is looked at once.
NUMBER_PATTERN = (r"(?iU)^[\s\x1c-\x1f]*([+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?|inf|infinity))"
                  r"[\s\x1c-\x1f]*$")


def parse_number(c: Column) -> Column:
    """Double value of a text cell; anything that is not a number becomes NULL, never NaN."""
    return F.nullif(F.regexp_extract(c.cast("string"), NUMBER_PATTERN, 1), F.lit("")).try_cast("double")


def null_nan(c: Column) -> Column:
    """NULL instead of NaN: a NaN compares as larger than every number."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def round_half_even(c: Column, digits: int = 2) -> Column:
    """Round the scaled value half to even (``round`` goes half up)."""
    scale = float(10 ** digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def cap_at(c: Column, upper: Column) -> Column:
    """Upper clip that keeps NULL (``least`` would skip it); no cap where ``upper`` is NULL."""
    return F.when(c > upper, upper).otherwise(c)


def share(part: Column, whole: Column) -> Column:
    """``part / whole`` with 0 for an empty denominator."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def order_key(v: Column, bits: int) -> Column:
    """Monotone integer key of a double: its binary exponent and ``bits`` leading mantissa bits.

    ``a <= b`` implies ``order_key(a) <= order_key(b)``, and keys with more bits refine keys
    with fewer bits, so the keys form nested value ranges whose number per power of two is
    ``2**bits`` whatever the data look like. Scaling by a power of two is exact, and a value
    next to a power of two gets the same key from either neighbouring exponent.
    """
    a = F.abs(v)
    e = F.greatest(F.floor(F.log2(a)), F.lit(-1000))
    cells = 1 << bits
    k = (e + F.lit(1100)) * F.lit(cells) + F.floor(a * F.pow(F.lit(2.0), F.lit(bits) - e)) - F.lit(cells)
    k = (F.when(a == 0.0, F.lit(0).cast("bigint"))
         .when(a == float("inf"), F.lit(3000 * cells).cast("bigint"))
         .otherwise(k))
    return F.when(v < 0, -k).otherwise(k)


def score_key(p: Column, bits: int) -> Column:
    """Like :func:`order_key`, but with equally fine cells near 0 and near 1.

    ``1 - p`` is exact for p in [0.5, 1], so saturated scores are told apart as well as tiny ones.
    """
    below = F.lit(-(1 << 50)).cast("bigint")
    return F.when(p <= 0.5, below + order_key(p, bits)).otherwise(-order_key(1.0 - p, bits))
