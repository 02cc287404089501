"""Ledger of stages: what went in and came out, and whether a stage has to run again."""

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from snapmart.sources.csv import can_read

ENTRY = "stage string, fingerprint string, rows_in bigint, rows_out bigint, rejected bigint, output string, finished timestamp"


def _digest(*parts) -> str:
    return hashlib.sha256("\n".join(map(str, parts)).encode()).hexdigest()


def content(df: DataFrame) -> list[Column]:
    """Aggregates that tell the rows of a table, whatever their order and files: their number and two sums over row hashes."""
    cells = [c for name in df.columns for c in (F.col(f"`{name}`").isNull(), F.col(f"`{name}`"))]
    sums = [F.coalesce(F.sum(F.xxhash64(F.lit(seed), *cells).cast("decimal(38,0)")), F.lit(0)).cast("string").alias(f"sum_{seed}") for seed in (1, 2)]
    return [F.count(F.lit(1)).alias("n_rows"), *sums]


@dataclass(frozen=True)
class Contents:
    """Rows of a table and a fingerprint of them."""

    rows: int
    fingerprint: str

    @classmethod
    def of(cls, df: DataFrame, found: dict) -> "Contents":
        return cls(found["n_rows"], _digest(df.schema.json(), *(found[k] for k in ("n_rows", "sum_1", "sum_2"))))


def contents(df: DataFrame) -> Contents:
    """Of a table, in one aggregate over it; one row reaches the driver."""
    return Contents.of(df, df.agg(*content(df)).first().asDict())


@dataclass
class Ledger:
    """One entry for each run of a stage, appended as a Parquet file below ``root`` when all it writes is there.

    A stage is skipped where its newest entry has the fingerprint of the same inputs and parameters and what it wrote still has as many
    rows as the newest entry for that place says. A stage that fails leaves no entry and runs again, and writes over what it left.
    """

    spark: SparkSession
    root: str
    _newest: dict | None = None

    @property
    def path(self) -> str:
        return f"{self.root.rstrip('/')}/ledger"

    def entries(self) -> DataFrame:
        if not can_read(self.spark, self.path):
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.read.schema(ENTRY).parquet(self.path)

    def newest(self, column: str, value: str) -> Row | None:
        """The newest entry of a stage or for an output. The newest ones, a few for each stage, are read once and kept."""
        if self._newest is None:
            last = self.entries().groupBy("stage", "output").agg(F.max_by(F.struct("*"), "finished").alias("e")).select("e.*").collect()
            self._newest = {}
            for entry in sorted(last, key=lambda e: e["finished"]):
                self._keep(entry)
        return self._newest.get((column, value))

    def _keep(self, entry: Row) -> None:
        self._newest |= {(column, entry[column]): entry for column in ("stage", "output")}

    def add(self, stage: str, fingerprint: str, rows_in: int, rows_out: int, output: str) -> None:
        entry = (stage, fingerprint, rows_in, rows_out, max(0, rows_in - rows_out), output, datetime.now())
        table = self.spark.createDataFrame([entry], ENTRY)
        table.coalesce(1).write.mode("append").parquet(self.path)
        self.newest("stage", stage)
        self._keep(Row(*table.columns)(*entry))

    def is_done(self, stage: str, fingerprint: str, output: str, kind: str = "parquet") -> bool:
        last = self.newest("stage", stage)
        if last is None or last["fingerprint"] != fingerprint or not can_read(self.spark, output):
            return False
        return self.rows(output, kind) == self.newest("output", output)["rows_out"]

    def rows(self, path: str, kind: str = "parquet") -> int:
        """Rows of a table; those of Parquet come from the footers."""
        if not can_read(self.spark, path):
            return 0
        try:
            return (self.spark.read.parquet(path) if kind == "parquet" else self.spark.read.csv(path, header=True)).count()
        except AnalysisException as e:
            if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # a partitioned table without rows has no files
                return 0
            raise

    def ingest(self, stage: str, df: DataFrame, output: str, write: Callable[[DataFrame, Callable], None], parameters=()) -> str:
        """A stage that reads data from outside, told by its rows. Returns the stage's fingerprint, which is an input of later ones.

        ``write(df, seen)`` writes ``seen(df)``: the first time rows are counted and hashed while they are written, by an ``Observation`` of that
        job alone; later an aggregate over them tells whether they have to be written.
        """
        if self.newest("stage", stage) is None and not df.isEmpty():
            seen = Observation(f"ledger-{stage}")
            write(df, lambda rows: rows.observe(seen, *content(rows)))
            found = Contents.of(df, seen.get)
            key = _digest(stage, *parameters, found.fingerprint)
        else:
            found = contents(df)
            key = _digest(stage, *parameters, found.fingerprint)
            if self.is_done(stage, key, output):
                return key
            write(df, lambda rows: rows)
        self.add(stage, key, found.rows, self.rows(output), output)
        return key

    def step(self, stage: str, inputs: list[str], rows_in: Callable[[], int], output: str, work: Callable[[], object], parameters=(), kind: str = "parquet") -> str:
        """A stage that reads what earlier ones wrote, told by their fingerprints ``inputs``, so no data are read to skip it."""
        key = _digest(stage, *parameters, *inputs)
        if not self.is_done(stage, key, output, kind):
            n = rows_in()
            work()
            self.add(stage, key, n, self.rows(output, kind), output)
        return key
