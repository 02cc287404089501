"""Session helpers: the shared folder and lineage cuts."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own; a cluster
    session without it is an error, because a machine-local folder would be lost
    together with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="snapmart-"))
    return sc.getCheckpointDir()


def workspace(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once in the shared folder and cut its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def tune(spark: SparkSession) -> SparkSession:
    """Runtime settings the operators profit from, unless the session has its own.

    The JVM never compiles a method of more than 8000 bytes of bytecode, so a whole-stage
    method beyond that runs interpreted; with this limit Spark generates smaller methods for
    such stages instead.
    """
    if spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "65535":
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark
