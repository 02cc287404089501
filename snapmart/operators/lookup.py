"""Join of a large frame with a lookup table."""

from pyspark.sql import DataFrame

from snapmart.session import workspace


def staged_lookup(table: DataFrame) -> DataFrame:
    """A lookup table written once in the shared folder. Spark knows its bytes and decides between broadcast and shuffle."""
    path = workspace(table.sparkSession, "lookup")
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def lookup_join(df: DataFrame, table: DataFrame, on: list) -> DataFrame:
    """Left join with a table that is unique on ``on``; adaptive execution splits a hot key of ``df``."""
    return df.join(table, on, "left")
