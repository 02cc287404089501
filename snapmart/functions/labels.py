"""Label coding."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapmart.functions.numbers import parse_number
from snapmart.functions.text import strip_text

# --- fixed values -------------------------------------------------------------------------
TRUE_LABELS = ["1", "yes", "y", "true", "t"]
FALSE_LABELS = ["0", "no", "n", "false", "f"]


def map_binary_label(c: Column) -> Column:
    """1/0 of a label written as word, letter or number (at least 0.5 is 1); else NULL."""
    s = F.lower(strip_text(c))
    number = parse_number(c)
    return (F.when(s.isin(*TRUE_LABELS), F.lit(1))
            .when(s.isin(*FALSE_LABELS), F.lit(0))
            .when(number.isNotNull(), (number >= 0.5).cast("int")))
