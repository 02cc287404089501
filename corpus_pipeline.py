"""A corpus for training: toxic documents out, repeated lines out, one document of each group of near copies, sources mixed, sequences packed."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapmart.llm import line_dedup, mixing, ngram_join, packing, toxicity
from snapmart.llm.common import documents, table, written
from snapmart.llm.queries import tokenizer

#: DuckDB SQL for the rows of ``run``: none, as no stage but the mixing's targets can be told in SQL.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose toxicity score stays below the threshold."""
    scored = toxicity.classify(docs, table(spark, sf_dir, "labels"), keep=[*docs.columns])
    return scored.where("predicted = 0").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that align with an earlier document; those of which nothing is left go."""
    done = line_dedup.dedup(docs).where((F.col("removed_lines") == 0) | (F.trim("text") != ""))
    chars = F.when(F.col("removed_lines") == 0, F.col("n_chars")).otherwise(F.length("text"))
    return done.withColumn("n_chars", chars.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that n-gram links hold together."""
    return ngram_join.first_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    mixed = mixing.mix(docs).where("copies > 0")
    return mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in training sequences."""
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_repeated_lines), ("ngram_jaccard_join", keep_one_of_near_copies),
          ("mixing", mix_sources), ("packing", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each written in the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
