"""Fitted dictionaries and fences, stored beside the layers and grown or reused by later runs."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.operators.clean import NumericSpec, iqr_fences
from snapmart.operators.fuzzy import FuzzySpec, distinct_texts, valued
from snapmart.operators.lookup import staged_lookup
from snapmart.sources.csv import can_read

ENTRY = "column string, text string, value string, version int"
FENCE = "fingerprint string, column string, q1 double, q3 double, upper double, version int"


@dataclass(frozen=True)
class Fits:
    """Below ``root``: ``dictionary`` with every text that was ever judged, and ``fences`` by the fingerprint of the table they were fitted on.

    Both are versioned by directories that are only added, so an earlier version can be read again.
    """

    spark: SparkSession
    root: str

    def dictionary(self, version: int | None = None) -> DataFrame:
        """(column, text, value, version) up to a version; the value is NULL where nothing is close enough."""
        path = f"{self.root}/dictionary"
        if not can_read(self.spark, path):
            return self.spark.createDataFrame([], ENTRY)
        entries = self.spark.read.schema(ENTRY).parquet(path)
        return entries if version is None else entries.filter(F.col("version") <= version)

    def grow(self, df: DataFrame, specs: dict[str, FuzzySpec]) -> DataFrame:
        """The dictionary with all texts of ``df``. Texts that are in it already are left out by an anti-join; only others are scored.

        Texts are distinct and combined map-side, so a text that a third of all rows hold is one row. A run that fails
        adds nothing or a whole version; a run that finds nothing new adds none.
        """
        specs = {c: s for c, s in specs.items() if c in df.columns}
        known = self.dictionary()
        if specs:
            texts = distinct_texts(df, specs)
            fresh = staged_lookup(valued(texts.join(known.select("column", "text"), ["column", "text"], "left_anti"), specs))
            if not fresh.isEmpty():
                version = (known.agg(F.max("version")).first()[0] or 0) + 1
                fresh.select("column", "text", "value").write.mode("overwrite").parquet(f"{self.root}/dictionary/version={version}")
        return self.dictionary()

    def fences(self, df: DataFrame, specs: dict[str, NumericSpec], fingerprint: str) -> dict:
        """Fences of the columns of ``df``: the stored ones of ``fingerprint``, which tells the table, or ones fitted now and stored under it.

        A few numbers for each column; a column without values has none.
        """
        path = f"{self.root}/fences"
        specs = {c: s for c, s in specs.items() if c in df.columns}
        stored = self.spark.read.schema(FENCE).parquet(path) if can_read(self.spark, path) else self.spark.createDataFrame([], FENCE)
        found = {r["column"]: {k: r[k] for k in ("q1", "q3", "upper")} for r in stored.filter(F.col("fingerprint") == fingerprint).collect()}
        if not found and specs:
            found = iqr_fences(df, specs)
            version = (stored.agg(F.max("version")).first()[0] or 0) + 1
            rows = [(fingerprint, c, f["q1"], f["q3"], f["upper"]) for c, f in found.items()]
            table = self.spark.createDataFrame(rows, FENCE.rpartition(",")[0])
            table.coalesce(1).write.mode("overwrite").parquet(f"{path}/version={version}")
        return found
