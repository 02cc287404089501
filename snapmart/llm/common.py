"""What several operators need: tables, whole texts, staged frames, and workers that give memory back."""

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from snapmart.session import workspace

#: The characters that part words.
SPACE = r"\x20\x09-\x0D"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str | Column) -> Column:
    """A text, with null read as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """The words of a text, parted by white space."""
    return F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[^{SPACE}]+")).cast("long")


def release() -> None:
    """Gives this process's free memory back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # other C libraries have none
    if trim:
        trim(0)


def released(run: Callable) -> Callable:
    """``run``, a function over the batches of a task, after which the worker's free memory goes back to the system.

    Python workers serve one stage after the other. Without this each keeps the most that any of its tasks ever needed, several
    hundred megabytes, while it is idle or another stage has need of them.
    """
    def run_and_release(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return run_and_release


def in_parts(column: pa.Array, rows: int = 512) -> Iterator:
    """The values of a column, so many of them made Python objects at once."""
    for at in range(0, len(column), rows):
        yield from column.slice(at, rows).to_pylist()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, lineage cut, any executor can read it."""
    path = workspace(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
