"""Document fingerprints: bottom-k sketches of shingle hashes."""

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from snapmart.llm.common import whole, words, written

K = 128
WORDS = 5
#: Rows that share a task while each looks up the document after it.
ROWS_PER_RANGE = 2000
RANGES = 64


def shingle_hashes(text: Column, n: int = WORDS) -> Column:
    """Distinct 48-bit hashes of the runs of ``n`` words; a shorter text is one run, an empty text has none."""
    hashed = F.transform(words(text), lambda w: F.xxhash64(w))

    def of(h):
        run = F.transform(F.sequence(F.lit(0), F.size(h) - n), lambda i: F.shiftrightunsigned(F.xxhash64(*[F.get(h, i + j) for j in range(n)]), 16))
        short = F.array(F.shiftrightunsigned(F.xxhash64(h), 16))
        none = F.array().cast("array<bigint>")
        return F.when(F.size(h) >= n, run).when(F.size(h) > 0, short).otherwise(none)

    return F.array_distinct(F.element_at(F.transform(F.array(hashed), of), 1))


def sketch(text: Column, k: int = K, n: int = WORDS) -> Column:
    """The ``k`` smallest shingle hashes, in order. Sketches of parts merge into the sketch of the whole."""
    return F.slice(F.sort_array(shingle_hashes(text, n)), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two texts' shingles together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity: the share of the merged sketch that both have. Two empty sketches are alike."""
    union = merged(a, b, k)
    both = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact while the sketch has fewer than ``k`` hashes."""
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) * F.lit(float(2**48)) / F.element_at(a, k))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first text's shingles that the second has, 0 to 1; an empty text is contained in any."""
    joint = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), joint / distinct_shingles(a, k)))


def as_text(a: Column) -> Column:
    """A sketch as text: twelve hexadecimal digits a hash."""
    return F.lower(F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 12, "0")), ""))


def from_text(fingerprint: Column) -> Column:
    digits = F.transform(F.sequence(F.lit(0), F.floor(F.length(fingerprint) / 12).cast("int") - 1), lambda i: F.substr(fingerprint, i * 12 + 1, F.lit(12)))
    return F.when(fingerprint == "", F.array().cast("array<bigint>")).otherwise(F.transform(digits, lambda x: F.conv(x, 16, 10).cast("bigint")))


def fingerprints(docs: DataFrame, text_column="text", k: int = K, n: int = WORDS) -> DataFrame:
    """``docs`` with ``sketch``, ``fingerprint`` (its text) and ``shingles`` (estimated count).

    Null texts are empty texts and have the empty fingerprint. Equal texts have equal fingerprints, in any table.
    Other columns stay; columns of the three names are replaced. No shuffle.
    """
    keep = [c for c in docs.columns if c not in ("sketch", "fingerprint", "shingles")]
    done = docs.select(*keep, sketch(whole(text_column), k, n).alias("sketch"))
    return done.select("*", as_text(F.col("sketch")).alias("fingerprint"), distinct_shingles(F.col("sketch"), k).alias("shingles"))


def _ranged(rows: DataFrame) -> DataFrame:
    """``rows`` (_id, _text) with ``_place``, a range of ids of about ROWS_PER_RANGE rows, and ``_order``, the order inside.

    Ranges come from quantiles of the ids and are even parts between two quantiles. Rows without an id come last and
    are spread over ranges by a hash of their text.
    """
    quantiles, count, nulls = rows.agg(F.percentile_approx("_id", [i / RANGES for i in range(RANGES + 1)], 10_000), F.count("_id"),
                                       F.count(F.when(F.col("_id").isNull(), 1))).first()
    bounds = sorted(set(quantiles or [0]))
    parts = max(1, math.ceil(count / RANGES / ROWS_PER_RANGE))
    steps = F.array(*[F.lit(b).cast("long") for b in bounds])
    below = F.greatest(F.lit(1), F.size(F.filter(steps, lambda b: b <= F.col("_id"))))
    start, end = F.get(steps, below - 1), F.get(steps, below)
    part = F.coalesce(F.floor((F.col("_id") - start) / (end - start) * parts), F.lit(0))
    spread = -1 - F.pmod(F.xxhash64("_text"), F.lit(max(1, math.ceil(nulls / ROWS_PER_RANGE))))
    inside = F.least(F.greatest(part, F.lit(0)), F.lit(parts - 1))
    return (rows.withColumn("_place", F.when(F.col("_id").isNull(), spread).otherwise(below * parts + inside).cast("long"))
            .withColumn("_order", F.coalesce("_id", F.xxhash64("_text"))))


def with_next(rows: DataFrame, carried: dict[str, Column]) -> DataFrame:
    """``rows`` (_id, _text) with the columns ``carried`` and ``_next``, a struct of those of the next row by descending id.

    After the last row comes the first. Rows meet in ranges of ids, so the carried columns are shuffled once; only the
    first row of each range is looked up from the range before it. Equal ids are ordered by text.
    """
    placed = _ranged(rows)
    # Written, so that Spark knows how few they are before it decides how to join them.
    heads = written(placed.groupBy("_place").agg(F.max("_order").alias("_order")), "range-heads")
    around = Window.orderBy(F.col("_place").desc())
    to = F.coalesce(F.lag("_place").over(around), F.min("_place").over(Window.partitionBy()))
    carry = F.struct(*carried)
    first = (placed.join(heads.withColumn("_to", to), ["_place", "_order"]).withColumns(carried).groupBy("_to")
             .agg(F.min_by(carry, F.col("_text")).alias("_head")).withColumnRenamed("_to", "_place"))
    inside = Window.partitionBy("_place").orderBy(F.col("_order").desc(), "_text")
    return (placed.withColumns(carried).withColumn("_next", F.lead(carry).over(inside)).join(first, "_place")
            .withColumn("_next", F.coalesce("_next", "_head")).drop("_place", "_order", "_head"))


def edited_fingerprints(docs: DataFrame, id_column="doc_id", text_column="text", k: int = K, n: int = WORDS) -> DataFrame:
    """Fingerprints of documents and of their edited texts, and how alike the sketches find them.

    Edited text: the last floor(n_chars / 2) code points give way to the first as many (or all) of the next document,
    by descending id. A single row is its own next document. Null texts are empty; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_column).alias("_id"), whole(text_column).alias("_text"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = (with_next(rows, {"_text": F.col("_text"), "_sketch": sketch(F.col("_text"), k, n)}).withColumn("n_chars", F.length("_text").cast("long"))
              .withColumn("_edited", F.concat(F.substr("_text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substr("_next._text", F.lit(1), half)))
              .withColumn("_new", sketch(F.col("_edited"), k, n)))
    return edited.select(F.col("_id").alias(id_column), "n_chars", F.sha2("_edited", 256).alias("edited_sha256"),
                         as_text(F.col("_sketch")).alias("fingerprint"), as_text(F.col("_new")).alias("edited_fingerprint"),
                         resemblance(F.col("_sketch"), F.col("_new"), k).alias("near_edited"),
                         resemblance(F.col("_sketch"), F.col("_next._sketch"), k).alias("near_next"))
