"""Text normalisation as Column expressions; everything stays inside codegen."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: tokens that count as missing -------------------------------------------
# compared in lower case without outer white space; "nan" also stands for NULL, "-" for any
# dash, and white space around a slash does not count
MISSING_TOKENS = ["unknown", "unk", "na", "n/a", "null", "none", "nan", "-", ""]

# a Unicode noncharacter, never part of text
CELL_BREAK = "\ufdd0"

# texts a CSV reader of the source system nulls at ingest
CSV_NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# --- fixed values: category spellings -----------------------------------------------------
GENDER_SPELLINGS = {
    "female": ["female", "f", "femail", "femole", "cemale", "femade", "femcle", "fomale",
               "gemale", "temale", "pemale", "nemale", "vale"],
    "male": ["male", "m", "maie", "mahe", "mace", "bale", "oale", "make", "maln", "maze"],
}
YES_NO_SPELLINGS = {
    "Yes": ["yes", "y", "yeah", "yep", "yess", "1", "true", "t", "on",
            "✓", "✔", "✔️", "是", "有", "开启", "开"],
    "No": ["no", "n", "nope", "0", "false", "f", "off", "✗", "✘", "否", "无", "关闭", "关"],
}
YES_NO_MISSING = ["", "na", "none", "nan"]
EDUCATION_SPELLINGS = {
    "Bachelor": ["bachelor", "bachclor", "bachelar", "machelor", "rachelor", "oachelor"],
    "HighSchool": ["highschool", "high school"],
    "College": ["college", "collage"],
}
EMPLOYMENT_SPELLINGS = {
    "Employed": ["employed"],
    "Retired": ["retired"],
    "Self-employed": ["self-employed"],
}
# misread digits of an income bracket, applied in this order
INCOME_DIGIT_FIXES = [("1[tfq]0", "150"), ("6[zf]", "60"), ("[mqv]", "0")]

_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
_INNER_SPACE = r"(?U)[\s\x1c-\x1f]+"


def strip_text(c: Column) -> Column:
    """Strip Unicode white space on both ends (``trim`` removes U+0020 only)."""
    return F.regexp_replace(c.cast("string"), _EDGE_SPACE, "")


def as_text(c: Column) -> Column:
    """Text of a cell, with the word ``nan`` for NULL."""
    return F.coalesce(c.cast("string"), F.lit("nan"))


def fold_case(c: Column) -> Column:
    """Stripped, lower-cased text of a cell."""
    return F.lower(strip_text(as_text(c)))


def fold_dashes(c: Column) -> Column:
    """Write an em or en dash as a hyphen."""
    return F.translate(c, "—–", "--")


def _missing_pattern(tokens, start: str, end: str) -> str:
    """Pattern of one missing cell between ``start`` and ``end``: any case, any dash, outer space."""
    space = r"[\s\x1c-\x1f]*"
    texts = [re.escape(t).replace(r"\-", "[-—–]").replace("/", rf"{space}/{space}") for t in tokens]
    return rf"(?iU)(?:{start}){space}(?:{'|'.join(texts)}){space}(?:{end})"


def is_missing_token(c: Column, tokens=MISSING_TOKENS) -> Column:
    """Is a text cell NULL or a missing token?"""
    return c.isNull() | c.rlike(_missing_pattern(tokens, "^", "$"))


def any_missing_token(cells, tokens=MISSING_TOKENS) -> Column:
    """Is any of several text cells NULL or a missing token?

    The cells are joined by a character reserved for internal use and meet one pattern, which
    keeps the generated code small however many cells there are.
    """
    row = F.concat_ws(CELL_BREAK, *[as_text(c) for c in cells])
    return row.rlike(_missing_pattern(tokens, f"^|{CELL_BREAK}", f"{CELL_BREAK}|$"))


def null_if_missing(c: Column, tokens=MISSING_TOKENS) -> Column:
    return F.when(~is_missing_token(c, tokens), c)


def null_csv_tokens(c: Column) -> Column:
    return F.when(~c.isin(*CSV_NULL_TOKENS), c)


def replace_known(c: Column, spellings: dict) -> Column:
    """Replace known spellings and leave every other text as it is."""
    out = c
    for canonical, known in spellings.items():
        out = F.when(c.isin(*known), canonical).otherwise(out)
    return out


def yes_no_text(c: Column) -> Column:
    """Fold case, drop trailing punctuation, write 1.0 as 1 and collapse white space."""
    s = F.regexp_replace(fold_case(c), "[，。、,.;：:]+$", "")
    s = F.regexp_replace(s, r"^\s*([01])\.0\s*$", "$1")
    return F.regexp_replace(s, _INNER_SPACE, " ")


def income_text(c: Column) -> Column:
    """Fold case, repair misread digits and fold the dashes of an income bracket."""
    s = fold_case(c)
    for pattern, repl in INCOME_DIGIT_FIXES:
        s = F.regexp_replace(s, pattern, repl)
    return fold_dashes(s)


def clean_header(name: str) -> str:
    """Column name without byte-order mark, with single plain spaces, stripped."""
    return " ".join(name.replace("\ufeff", "").split())
