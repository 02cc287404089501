"""N-gram Jaccard join: MinHash candidates, Bayesian pruning, exact verification."""

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from snapmart.llm.common import in_parts, released, whole, written
from snapmart.llm.graph import components

WORDS = 5
THRESHOLD = 0.8
#: Bands and rows of the signatures: a pair of similarity 0.8 misses all bands once in 1.6e9.
BANDS, ROWS = 40, 4
#: Hashes after which pairs are dropped whose posterior probability of reaching the threshold is below the tolerance.
CHECKPOINTS = (16, 32, 64, 96, 160)
TOLERANCE = 1e-8
#: Texts compared in one task; a larger group of candidates is compared by pairs of blocks of this size.
BLOCK = 400
#: Shingles, and words that a Python worker remembers, at once.
CHUNK = 400_000
REMEMBERED = 150_000

_rng = np.random.default_rng(5)
MULTIPLIERS = _rng.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLACES = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_known: dict[str, int] = {}


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def shingles(text: str, n: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``n`` words; a shorter text is one run, an empty one has none."""
    words = text.split()
    if not words:
        return np.empty(0, np.uint64)
    try:
        h = np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))
    except KeyError:
        if len(_known) > REMEMBERED:
            _known.clear()
        for w in words:
            if w not in _known:
                _known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "replace"))
        h = np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))
    size = min(n, len(words))
    runs = np.zeros(len(words) - size + 1, np.uint64)
    for j in range(size):
        runs += h[j:len(h) - size + 1 + j] * PLACES[j]
    return np.unique(_mixed(runs + np.uint64(size)))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values, a row for each set; empty sets have all ones."""
    out = np.full((len(sets), BANDS * ROWS), 2**32 - 1, np.uint32)
    full = np.array([i for i, s in enumerate(sets) if len(s)], int)
    at = 0
    while at < len(full):
        end, size = at, 0
        while end < len(full) and (end == at or size + len(sets[full[end]]) <= CHUNK):
            size += len(sets[full[end]])
            end += 1
        some = full[at:end]
        flat = np.concatenate([sets[i] for i in some])
        starts = np.append(0, np.cumsum([len(sets[i]) for i in some])[:-1])
        for k, m in enumerate(MULTIPLIERS):
            out[some, k] = np.minimum.reduceat(((flat * m) >> np.uint64(32)).astype(np.uint32), starts)
        at = end
    return out


def least_matches(checkpoints=CHECKPOINTS, threshold=THRESHOLD, tolerance=TOLERANCE) -> list[int]:
    """For each number of compared hashes, the matches below which a pair is dropped.

    With any similarity as likely before, the posterior probability that a pair with m of n matches reaches the threshold t is
    P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in checkpoints:
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def candidate_pairs(signature: np.ndarray, across: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows (i < j) that stay after each checkpoint; with ``across``, only those of different sides."""
    i, j = np.triu_indices(len(signature), 1)
    if across is not None:
        keep = across[i] != across[j]
        i, j = i[keep], j[keep]
    matches, done = np.zeros(len(i), np.int16), 0
    for n, least in zip(CHECKPOINTS, least_matches(), strict=True):
        for k in range(done, n):
            column = signature[:, k]
            matches += column[i] == column[j]
        keep = matches >= least
        i, j, matches, done = i[keep], j[keep], matches[keep], n
    return i, j


def intersections(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact sizes of the intersections of pairs of sets; many pairs of few sets go through products of incidence matrices."""
    if len(i) < 8 * len(sets):
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j, strict=True)], np.int64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    column, owner = np.unique(column[shared], return_inverse=True)[1], owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int(column.max(initial=-1)) + 1, 4096):
        lo, hi = np.searchsorted(column, [start, start + 4096])
        part = np.zeros((len(sets), 4096), np.float32)
        part[owner[lo:hi], column[lo:hi] - start] = 1
        both += part @ part.T
    return both[i, j].astype(np.int64)


def links(sets: list[np.ndarray], across: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets whose Jaccard similarity is the threshold or more."""
    i, j = candidate_pairs(signatures(sets), across)
    size = np.array([len(s) for s in sets], np.int64)
    both = intersections(sets, i, j)
    either = size[i] + size[j] - both
    # In integers: 5 * intersection >= 4 * union is a similarity of 0.8 or more.
    top, bottom = THRESHOLD.as_integer_ratio() if THRESHOLD != 0.8 else (4, 5)
    keep = (bottom * both >= top * either) & (either > 0)
    return i[keep], j[keep]


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Band keys of the texts in the last column, instead of it."""
    for batch in batches:
        n = batch.num_rows
        keys = np.empty((n, BANDS), np.int64)
        sizes = np.empty(n, np.int64)
        held: list[np.ndarray] = []
        size, at = 0, 0
        for k, text in enumerate(in_parts(batch.column(batch.num_columns - 1))):
            held.append(shingles(text))
            sizes[k] = len(held[-1])
            size += len(held[-1])
            if size > CHUNK or k + 1 == n:
                rows = signatures(held).reshape(len(held), BANDS, ROWS).astype(np.uint64)
                h = np.full((len(held), BANDS), 1, np.uint64) * np.arange(1, BANDS + 1, dtype=np.uint64)
                for r in range(ROWS):
                    h = _mixed(h * PLACES[r] + rows[:, :, r])
                keys[at:at + len(held)] = h.view(np.int64)
                at, held, size = at + len(held), [], 0
        bands = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * BANDS, pa.int32()), pa.array(keys.ravel()))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sizes), bands], [*batch.schema.names[:-1], "_n", "_bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles(t).tobytes() for t in in_parts(batch.column(batch.num_columns - 1))]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sets, pa.large_binary() if sum(map(len, sets)) > 2**30 else pa.binary())], [*batch.schema.names[:-1], "_set"])


def _compared(key, rows: pd.DataFrame) -> pd.DataFrame:
    """Links of one group of candidates, or between two blocks of it: for each text, linked documents and the least text it hangs together with."""
    rows = rows.sort_values("_node")
    sets = [np.frombuffer(b, np.uint64) for b in rows["_set"]]
    i, j = links(sets, None if key[1] == key[2] else rows["_block"].to_numpy())
    copies, nodes = rows["_copies"].to_numpy(), rows["_node"].to_numpy()
    degree = np.bincount(i, copies[j], len(nodes)) + np.bincount(j, copies[i], len(nodes))
    root = np.arange(len(nodes))
    while True:
        low = root.copy()
        np.minimum.at(low, i, root[j])
        np.minimum.at(low, j, root[i])
        low = low[low]
        if (low == root).all():
            break
        root = low
    return pd.DataFrame({"_node": nodes, "_links": degree.astype(np.int64), "_root": nodes[root]})[degree > 0]


def classes(docs: DataFrame, id_column="doc_id", text_column="text") -> DataFrame:
    """Internal form of ``join``: ``_row, _id, _copy, _node, class_id, n_links``; _copy is the digest of the text."""
    rows = docs.select(F.col(id_column).alias("_id"), whole(text_column).alias("_text"))
    kind = dict(rows.dtypes)["_id"]
    signed = rows.select("_id", F.unhex(F.md5("_text")).alias("_copy"), "_text").mapInArrow(released(_signed), f"_id {kind}, _copy binary, _n bigint, _bands array<bigint>")
    signed = written(signed.withColumn("_row", F.monotonically_increasing_id()), "ngram-bands")
    # Copies are one text, which stands for all of them; its row is the least.
    copies = signed.groupBy("_copy").agg(F.min("_row").alias("_node"), F.count(F.lit(1)).alias("_copies"), F.min("_id").alias("_first"))
    texts = written(copies.join(signed.select(F.col("_row").alias("_node"), "_id", "_n", "_bands"), "_node"), "ngram-texts")
    banded = texts.where("_n > 0").select("_node", F.explode("_bands").alias("_band"))
    buckets = banded.groupBy("_band").agg(F.min("_node").alias("_least"), F.max("_node").alias("_most")).where("_least < _most").select("_band", "_least")
    near = components(banded.join(buckets, "_band").where("_node > _least").select(F.col("_node").alias("_a"), F.col("_least").alias("_b")))
    blocks = near.groupBy("_root").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("_blocks"))
    chosen = written(near.join(blocks, "_root").join(texts.select("_node", "_id", "_copy", "_copies"), "_node"), "ngram-candidates")

    keyed = rows.select("_id", F.unhex(F.md5("_text")).alias("_copy"), "_text")
    # Candidates grow with the corpus, so texts meet them in a merge join at every size.
    found = (keyed.join(chosen.hint("merge"), keyed["_id"].eqNullSafe(chosen["_id"]) & (keyed["_copy"] == chosen["_copy"]))
             .select("_root", "_node", "_copies", "_blocks", "_text"))
    sets = (found.mapInArrow(released(_sets), "_root bigint, _node bigint, _copies bigint, _blocks int, _set binary").dropDuplicates(["_node"])
            .withColumn("_block", F.pmod(F.xxhash64("_node"), F.col("_blocks")).cast("int"))
            .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
            .withColumn("_i", F.least("_block", "_other")).withColumn("_j", F.greatest("_block", "_other")))
    compared = written(sets.groupBy("_root", "_i", "_j").applyInPandas(_compared, "_node bigint, _links bigint, _root bigint"), "ngram-links")
    degree = compared.groupBy("_node").agg(F.sum("_links").alias("_links"))
    roots = components(compared.select(F.col("_node").alias("_a"), F.col("_root").alias("_b")))
    grouped = texts.select("_node", "_copy", "_copies", "_first").join(degree, "_node", "left").join(roots, "_node", "left").withColumn("_root", F.coalesce("_root", "_node"))
    # A group's class is its least id; ids that are null stand aside.
    least = grouped.groupBy("_root").agg(F.min("_first").alias("class_id"))
    final = grouped.join(least, "_root").select("_copy", "_node", "_root", "class_id", (F.coalesce("_links", F.lit(0)) + F.col("_copies") - 1).alias("n_links"))
    return signed.select("_row", "_id", "_copy").join(final, "_copy")


def join(docs: DataFrame, id_column="doc_id", text_column="text") -> DataFrame:
    """``doc_id, class_id, n_links``: one row for each row of ``docs``.

    Links are pairs of documents whose sets of five-word runs have a Jaccard similarity of 0.8 or more. Equal texts are one text
    until the end: each copy is linked to the others, and has the links of its text. MinHash bands find candidates; their
    connected groups are compared pair by pair, in blocks where a group is large: pairs are dropped at the first checkpoint at
    which their posterior probability is below the tolerance, and those that stay are verified exactly. ``class_id`` is the
    least id of the documents that hang together by links, ``n_links`` the number of a document's links.

    Null texts are empty, and empty texts are copies of each other but linked to nothing else; a text of fewer than five words
    is one run; a null id has the class id of its group, null if all its ids are; repeated rows are copies; an empty
    table gives an empty result; other columns are left out.
    """
    return classes(docs, id_column, text_column).select(F.col("_id").alias(id_column), "class_id", "n_links")


def first_of_each(docs: DataFrame, id_column="doc_id", text_column="text") -> DataFrame:
    """The rows of ``docs`` less near duplicates: of each group the row with the least id stays; all columns stay."""
    kept = (classes(docs, id_column, text_column)
            .groupBy("_root").agg(F.min(F.struct(F.col("_id").isNull().alias("_none"), "_id", "_copy")).alias("_kept"))
            .select(F.col("_kept._id").alias("_kept_id"), F.col("_kept._copy").alias("_kept_copy")))
    copy = F.unhex(F.md5(whole(text_column)))
    keyed = docs.withColumn("_kept_copy", copy).withColumn("_kept_id", F.col(id_column))
    there = keyed.join(kept.withColumnRenamed("_kept_id", "_k"), "_kept_copy").where(F.col("_kept_id").eqNullSafe(F.col("_k")))
    return there.dropDuplicates(["_kept_copy"]).select(*docs.columns)
