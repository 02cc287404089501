"""Versioned model directories: ``<root>/<name>/version=<n>``."""

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from snapmart.operators.models import SnapshotModel, load_model
from snapmart.sources.csv import can_read


def latest_version(spark: SparkSession, root: str, name: str) -> int | None:
    """Highest version, read from the directory names of the stored descriptions."""
    pattern = f"{root}/{name}/version=*/meta"
    if not can_read(spark, pattern):
        return None
    path = F.col("_metadata.file_path")
    versions = spark.read.text(pattern).select(F.regexp_extract(path, r"version=(\d+)", 1).cast("int").alias("v"))
    return versions.agg(F.max("v").alias("v")).first()["v"]


def save_version(spark: SparkSession, model: SnapshotModel, root: str, name: str) -> str:
    path = f"{root}/{name}/version={(latest_version(spark, root, name) or 0) + 1}"
    model.save(spark, path)
    return path


def load_latest(spark: SparkSession, root: str, name: str) -> SnapshotModel:
    version = latest_version(spark, root, name)
    if version is None:
        raise FileNotFoundError(f"no model {name} in {root}")
    return load_model(spark, f"{root}/{name}/version={version}")
