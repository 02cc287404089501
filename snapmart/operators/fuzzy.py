"""Fuzzy canonicalisation of noisy categories.

A dictionary job works on the *distinct* normalised values of a column: known spellings are
replaced, the rest is scored against the choices, and what is close enough enters the
dictionary. Rows are then only normalised and looked up. The string similarity is the one thing
here that Spark has no expression for, so it is an Arrow UDF over the distinct values.
"""

from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.functions import text
from snapmart.operators.lookup import lookup_join, staged_lookup
from snapmart.operators.ordering import long_values
from snapmart.operators.rows import compute_once


@dataclass(frozen=True)
class FuzzySpec:
    """How one column is canonicalised."""

    choices: list
    prepare: Callable[[Column], Column] = text.fold_case
    spellings: dict = field(default_factory=dict)
    missing: tuple = ("",)
    min_score: float = 70.0
    inclusive: bool = False
    show: Callable[[Column], Column] = lambda c: c

    def known(self, prepared: Column) -> Column:
        """Known spellings of a normalised value replaced; NULL where it stands for missing."""
        s = text.replace_known(prepared, self.spellings)
        return F.when(~s.isin(*self.missing), s) if self.missing else s

    def accepted(self, score: Column) -> Column:
        return score >= self.min_score if self.inclusive else score > self.min_score


GENDER = FuzzySpec(["female", "male"], spellings=text.GENDER_SPELLINGS)
YES_NO = FuzzySpec(["Yes", "No"], prepare=text.yes_no_text, spellings=text.YES_NO_SPELLINGS,
                   missing=tuple(text.YES_NO_MISSING), inclusive=True)
EDUCATION = FuzzySpec(["HighSchool", "College", "Bachelor"], spellings=text.EDUCATION_SPELLINGS)
EMPLOYMENT = FuzzySpec(["Employed", "Retired", "Self-employed"], spellings=text.EMPLOYMENT_SPELLINGS)
INCOME = FuzzySpec(["60-100k", "100-150k", ">150k"], prepare=text.income_text, missing=(),
                   show=lambda c: F.translate(c, "-", "–"))

DEMOGRAPHIC_SPECS = {
    "gender": GENDER, "Partner": YES_NO, "Dependents": YES_NO, "EducationLevel": EDUCATION,
    "EmploymentStatus": EMPLOYMENT, "AnnualIncomeBracket": INCOME,
}


def best_match_udf(choices_by_column: dict):
    """UDF (column, value) -> (best choice, score 0..100); the first of equal scores wins."""

    def best_match(column: pd.Series, value: pd.Series) -> pd.DataFrame:
        from difflib import SequenceMatcher

        seen = {}
        for pair in set(zip(column, value)):
            col, val = pair
            if val is None:
                seen[pair] = (None, None)
                continue
            ratios = [100.0 * SequenceMatcher(None, val, c).ratio() for c in choices_by_column[col]]
            top = max(range(len(ratios)), key=ratios.__getitem__)
            seen[pair] = (choices_by_column[col][top], ratios[top])
        return pd.DataFrame([seen[p] for p in zip(column, value)], columns=["best", "score"])

    return F.pandas_udf(best_match, "best string, score double")


def distinct_texts(df: DataFrame, specs: dict[str, FuzzySpec]) -> DataFrame:
    """(column, text, known) of the distinct normalised values of all columns, combined map-side."""
    return _known(raw_texts(df, specs).filter(F.col("text").isNotNull()).select("column", "text").distinct(), specs)


def raw_texts(df: DataFrame, specs: dict[str, FuzzySpec]) -> DataFrame:
    """(column, raw, text): the distinct cells of all columns, NULL read as ``as_text`` does, and their normalised texts.

    Equal cells are combined map-side before they are normalised, so patterns are matched once for each text, after the shuffle and not
    in the tasks of the scan.
    """
    raws = long_values(df, {c: text.as_text(F.col(c)) for c in specs}, values="raw").distinct()
    return compute_once(raws, {"text": _by_column({c: s.prepare(F.col("raw")) for c, s in specs.items()})})


def _by_column(values: dict[str, Column]) -> Column:
    """The expression of the column that a (column, ...) row is of."""
    out = F.lit(None).cast("string")
    for c, value in values.items():
        out = F.when(F.col("column") == c, value).otherwise(out)
    return out


def _known(texts: DataFrame, specs: dict[str, FuzzySpec]) -> DataFrame:
    return compute_once(texts, {"known": _by_column({c: s.known(F.col("text")) for c, s in specs.items()})})


def _is_choice(specs: dict[str, FuzzySpec], value: str) -> Column:
    out = F.lit(False)
    for c, s in specs.items():
        out = F.when(F.col("column") == c, F.col(value).isin(*s.choices)).otherwise(out)
    return out


def _scored(texts: DataFrame, specs: dict[str, FuzzySpec]) -> DataFrame:
    """Add ``best`` and ``score``; a value that already is a choice does not reach the UDF."""
    match = best_match_udf({c: s.choices for c, s in specs.items()})
    open_value = F.when(~_is_choice(specs, "known"), F.col("known"))
    return (texts.withColumn("_m", match("column", open_value))
            .withColumns({"best": F.col("_m.best"), "score": F.col("_m.score")}).drop("_m"))


def fuzzy_dictionary(df: DataFrame, specs: dict[str, FuzzySpec]) -> DataFrame:
    """(column, raw, best, score) of every distinct value that is not a known one."""
    scored = _scored(distinct_texts(df, specs), specs).filter(F.col("score").isNotNull())
    return scored.select("column", F.col("known").alias("raw"), "best", "score").distinct()


def category_dictionary(df: DataFrame, specs: dict[str, FuzzySpec]) -> DataFrame:
    """(column, raw, value): the canonical value of every distinct cell that has one, NULL as ``raw_texts`` has it."""
    raws = staged_lookup(raw_texts(df, specs))
    texts = _known(raws.filter(F.col("text").isNotNull()).select("column", "text").distinct(), specs)
    values = staged_lookup(valued(texts, specs).filter(F.col("value").isNotNull()))
    return raws.join(values, ["column", "text"]).select("column", "raw", "value")


def valued(texts: DataFrame, specs: dict[str, FuzzySpec]) -> DataFrame:
    """(column, text, value) of distinct texts as ``distinct_texts`` gives them; NULL where no choice is close enough."""
    accepted = F.lit(None).cast("string")
    shown = F.lit(None).cast("string")
    for c, s in specs.items():
        here = F.col("column") == c
        accepted = F.when(here, F.when(s.accepted(F.col("score")), F.col("best"))).otherwise(accepted)
        shown = F.when(here, s.show(F.col("_value"))).otherwise(shown)
    value = F.coalesce(F.when(_is_choice(specs, "known"), F.col("known")), accepted)
    return _scored(texts, specs).withColumn("_value", value).select("column", "text", shown.alias("value"))


def canonicalize(df: DataFrame, specs: dict[str, FuzzySpec], dictionary: DataFrame | None = None) -> DataFrame:
    """Replace each column of ``specs`` by its canonical value, or NULL where none is close enough.

    A stored ``dictionary`` (column, text, value) that has all texts of ``df`` is taken as it is, and rows are normalised to meet it. Without
    one, only distinct cells are normalised and only distinct texts reach Python; rows meet the dictionary by their cells. The dictionary is
    written, so that Spark knows its bytes and decides between broadcast and shuffle; the rows themselves are never sent to Python.
    """
    specs = {c: s for c, s in specs.items() if c in df.columns}
    if not specs:
        return df
    table, found = (staged_lookup(category_dictionary(df, specs)), "raw") if dictionary is None else (dictionary, "text")
    out = df.withColumns({f"_text_{c}": text.as_text(F.col(c)) if found == "raw" else s.prepare(F.col(c)) for c, s in specs.items()})
    for c in specs:
        part = table.filter(F.col("column") == c).select(F.col(found).alias(f"_text_{c}"), F.col("value").alias(f"_value_{c}"))
        out = lookup_join(out, part, [f"_text_{c}"])
    return out.select(*[F.col(f"_value_{c}").alias(c) if c in specs else F.col(c) for c in df.columns])
