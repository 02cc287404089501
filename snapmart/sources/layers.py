"""Layers of Parquet tables, partitioned by snapshot date where they have one."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.functions.dates import date_from_name
from snapmart.operators.splits import snapshot_range
from snapmart.sources.csv import ORDER, can_read, read_csv_any

LAYERS = ("bronze", "silver", "gold")


def layer_path(root: str, layer: str, table: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{table}"


def write_snapshots(df: DataFrame, path: str, snap: str = "snapdate", mode: str = "overwrite") -> None:
    """Write one directory per snapshot date.

    The rebalance hint gathers each date into few files and splits a date that holds a large
    share of the rows over several tasks, by the sizes seen at run time.
    """
    df.hint("rebalance", snap).write.mode(mode).partitionBy(snap).parquet(path)


def overwrite_snapshots(df: DataFrame, path: str, snap: str = "snapdate") -> None:
    """Replace only the dates that occur in ``df``. It must not read from ``path`` itself."""
    (df.hint("rebalance", snap).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(snap).parquet(path))


def read_snapshots(spark: SparkSession, path: str, start: str | None = None, end: str | None = None,
                   snap: str = "snapdate", required: bool = False) -> DataFrame:
    """Snapshots of an inclusive date range; the range prunes directories.

    ``required`` makes an empty range an error, as for a training set.
    """
    df = spark.read.parquet(path)
    if start is not None:
        df = snapshot_range(df, start, end, snap)
    if required and df.isEmpty():
        raise ValueError(f"no snapshots between {start} and {end} in {path}")
    return df


def read_named_files(spark: SparkSession, path: str, snap: str = "snapdate", order: str | None = ORDER, **options) -> DataFrame:
    """CSV files whose names, or folders' names, carry the date (``gold_YYYY_MM_DD.csv``), as one table; others are skipped."""
    file = F.regexp_extract(F.col("_metadata.file_path"), r"[^/]*\d{4}_\d{2}_\d{2}[^/]*", 0)
    df = read_csv_any(spark, path, order=order, extra={snap: date_from_name(file)}, **options)
    return df.filter(F.col(snap).isNotNull())


def newest_file(spark: SparkSession, path: str) -> str:
    """Path of the file changed last, from file listings only."""
    files = spark.read.format("binaryFile").load(path)
    return files.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path")).first()["path"]


def promote(spark: SparkSession, sources: dict[str, str], root: str, layer: str) -> list:
    """Copy tables unchanged into a layer; returns the names that were missing and goes on."""
    missing = []
    for name, path in sources.items():
        if can_read(spark, path):
            spark.read.parquet(path).write.mode("overwrite").parquet(layer_path(root, layer, name))
        else:
            missing.append(name)
    return missing


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
