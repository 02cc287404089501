"""Registered queries of the operators, over whole tables, with production parameters."""

import os

from pyspark.sql import functions as F

from snapmart.llm import fingerprints, language_id, lexical_search, line_dedup, mixing, neighbours, ngram_join, packing, quality, secret_scan, substring_dedup, toxicity, whitening
from snapmart.llm.common import documents, table
from snapmart.llm.oracles import ORACLES

#: Folder of the public tokenizers' files; without it the installed package tells.
TOKENIZERS = os.environ.get("PUBLIC_TOKENIZERS")


def tokenizer(name):
    if TOKENIZERS:
        return f"{TOKENIZERS}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"))


def op2_ngram_jaccard_join(spark, sf_dir):
    return ngram_join.join(documents(spark, sf_dir))


def op3_document_fingerprints(spark, sf_dir):
    return fingerprints.edited_fingerprints(documents(spark, sf_dir))


def op4_suffix_array_dedup(spark, sf_dir):
    return substring_dedup.dedup(documents(spark, sf_dir)).drop("kept")


def op5_nearest_neighbours(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.search(vectors, F.col("vec_id") % 20 == 0)


def op6_secret_scans(spark, sf_dir):
    return secret_scan.scan(documents(spark, sf_dir)).drop("found")


def op7_line_dedup(spark, sf_dir):
    done = line_dedup.dedup(documents(spark, sf_dir))
    return done.select("doc_id", "lines", "removed_lines", F.length("text").cast("long").alias("kept_chars"), F.sha2("text", 256).alias("kept_sha256"))


def op8_mix_sources(spark, sf_dir):
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")


def op9_quality_classifier(spark, sf_dir):
    return quality.classify(documents(spark, sf_dir), table(spark, sf_dir, "labels"), keep=["doc_id"])


def op10_toxicity(spark, sf_dir):
    return toxicity.classify(documents(spark, sf_dir), table(spark, sf_dir, "labels"), keep=["doc_id"])


def op11_language_id(spark, sf_dir):
    return language_id.classify(documents(spark, sf_dir), tokenizer("byte_bpe_multi_50k.tiktoken"), keep=["doc_id"])


def op12_embedding_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_ranked_lexical_search(spark, sf_dir):
    return lexical_search.rank(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


# What SQL can tell of results that it can't make: the columns of these queries come from the operators' own results.


def edited_texts(spark, sf_dir):
    """Of op3: lengths, and the hashes of the edited texts."""
    return op3_document_fingerprints(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256")


def base_secrets(spark, sf_dir):
    """Of op6: the numbers of spans of the fixed patterns."""
    return op6_secret_scans(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex")


def mix_targets(spark, sf_dir):
    """Of op8: each source's size and target, and whether its words come near the target, by half its longest document."""
    mixed = op8_mix_sources(spark, sf_dir).join(documents(spark, sf_dir).select("doc_id", "source"), "doc_id")
    sums = mixed.groupBy("source").agg(F.max("source_size").alias("source_size"), F.max("target").alias("target"), F.sum("taken").alias("taken"),
                                       F.max("size").alias("longest"), F.max(F.col("taken") - 2 * F.col("size")).alias("over"))
    near = (F.abs(F.col("taken") - F.col("target")) <= F.col("longest") / 2 + 1) & (F.col("over") <= 0)
    return sums.select("source", "source_size", F.round(F.col("target") + 1e-9, 3).alias("target"), near.alias("near"))


def vector_deviations(spark, sf_dir):
    """Of op12: rows of the fit and each vector's exact deviation, with the number of its components and whether the identity is met."""
    rows = op12_embedding_whitening(spark, sf_dir)
    return rows.groupBy("vec_id", "n", "deviation").agg(F.count(F.lit(1)).alias("components"), (F.max("identity_error") <= 1e-4).alias("white"))


CHECKS = (edited_texts, base_secrets, mix_targets, vector_deviations)


def registered():
    return {f.__name__: f for f in (*CHECKS, op1_best_fit_packing, op2_ngram_jaccard_join, op3_document_fingerprints, op4_suffix_array_dedup, op5_nearest_neighbours, op6_secret_scans, op7_line_dedup, op8_mix_sources,
                                      op9_quality_classifier, op10_toxicity, op11_language_id, op12_embedding_whitening, op13_ranked_lexical_search)}


def oracle_sql():
    return dict(ORACLES)
