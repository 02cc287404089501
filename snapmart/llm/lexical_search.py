"""Ranked lexical search, reversed: documents stream through a broadcast inverted index of the items' terms."""

from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from snapmart.llm.common import whole, written
from snapmart.llm.quality import chunks

#: Characters that part terms; the others are ASCII digits and letters and everything beyond ASCII.
SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_TERMS = bytes.maketrans(SEPARATORS + bytes(range(0x41, 0x5B)), b" " * len(SEPARATORS) + bytes(range(0x61, 0x7B)))

#: Pairs of an item and a term that are searched with at once (more items are dealt into slices), which bounds what is broadcast.
POSTINGS = 1 << 18
#: Cells of scores, and sums into them, that a task works on at once.
CELLS = 1 << 21
#: Groups that the heaps of an item are merged in before they meet.
SALTS = 64


class Index(NamedTuple):
    """The inverted index of a slice: the items of term t are ``items[starts[t]:starts[t + 1]]``, numbers into ``ids``."""

    terms: list
    starts: np.ndarray
    items: np.ndarray
    ids: list


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text: maximal runs of other characters than separators, only A-Z in lower case."""
    return text.translate(_TERMS).split()


def item_terms(items: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``_item, _term`` once for each term of an item."""
    rows = items.where(F.col(id_column).isNotNull()).select(F.col(id_column).alias("_item"), whole(text_column).cast("binary").alias("_text"))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [sorted(set(terms(t))) for t in batch.column(1).to_pylist()]
            rows = np.repeat(np.arange(len(own)), [len(x) for x in own])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array([t for x in own for t in x], pa.binary())], ["_item", "_term"])

    return rows.mapInArrow(found, f"_item {rows.schema['_item'].dataType.simpleString()}, _term binary").distinct()


def slices(postings: DataFrame, most: int = POSTINGS) -> tuple[int, Column]:
    """How many slices of items keep to ``most`` postings (or hold one item), and the slice of a row."""
    n = 1
    while True:
        own = F.pmod(F.xxhash64("_item"), F.lit(n))
        sizes = postings.groupBy(own.alias("_slice")).agg(F.count("*").alias("rows"), F.min("_item").alias("lo"), F.max("_item").alias("hi"))
        if sizes.where((F.col("rows") > most) & (F.col("lo") != F.col("hi"))).isEmpty():
            return n, own
        n *= 2


def index_of(postings: DataFrame) -> Index:
    """The index of one slice; its postings are few by the choice of slices."""
    rows = postings.toArrow()
    item, term = rows.column("_item").to_pylist(), rows.column("_term").to_pylist()
    ids, words = sorted(set(item)), sorted(set(term))
    items, numbers = {x: i for i, x in enumerate(ids)}, {x: i for i, x in enumerate(words)}
    pairs = np.array(sorted((numbers[t], items[i]) for t, i in zip(term, item, strict=True)), np.int64).reshape(-1, 2)
    return Index(words, np.searchsorted(pairs[:, 0], np.arange(len(words) + 1)), pairs[:, 1], ids)


def counted(docs: DataFrame, index) -> DataFrame:
    """``_doc, _n, _terms, _counts``: each document with a term, its number of terms, and how often it holds those of the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: i for i, t in enumerate(index.value.terms)}
        size = max(1, len(number))
        for batch in batches:
            at = 0
            for texts in chunks(batch.column(1).to_pylist()):
                own = [terms(t) for t in texts]
                n = np.array([len(x) for x in own], np.int64)
                ids = np.fromiter(map(number.get, (t for x in own for t in x), repeat(-1)), np.int64, int(n.sum()))
                doc = np.repeat(np.arange(len(n)), n)
                keys, counts = np.unique(doc[ids >= 0] * size + ids[ids >= 0], return_counts=True)
                starts = pa.array(np.searchsorted(keys, np.arange(len(n) + 1) * size).astype(np.int32))
                made = pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(n)), pa.array(n), pa.ListArray.from_arrays(starts, pa.array((keys % size).astype(np.int32))), pa.ListArray.from_arrays(starts, pa.array(counts.astype(np.int64)))],
                    ["_doc", "_n", "_terms", "_counts"])
                yield made.filter(pa.array(n > 0))
                at += len(n)

    return docs.mapInArrow(run, "_doc bigint, _n bigint, _terms array<int>, _counts array<bigint>")


def flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths of the rows' lists, terms and counts of all rows one after the other."""
    lengths = np.diff(batch.column("_terms").offsets.to_numpy())
    return lengths, batch.column("_terms").flatten().to_numpy(), batch.column("_counts").flatten().to_numpy()


def statistics(found: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Documents, terms in them, and how many documents hold each term of the index: one row a term and task is summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size + 2, np.int64)
        for batch in batches:
            sums[:size] += np.bincount(flat(batch)[1], minlength=size)
            sums[size:] += batch.num_rows, batch.column("_n").to_numpy().sum()
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some])], ["_term", "_df"])

    total = np.zeros(size + 2, np.int64)
    for r in found.mapInArrow(run, "_term bigint, _df bigint").groupBy("_term").agg(F.sum("_df").alias("_df")).collect():
        total[r["_term"]] = r["_df"]
    return int(total[size]), int(total[size + 1]), total[:size]


class Heaps:
    """The ``k`` best documents of each item so far; equal scores by the smaller id."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, np.int64)
        self.item = self.doc = self.score = np.empty(0, np.int64)

    def push(self, item: np.ndarray, doc: np.ndarray, score: np.ndarray) -> None:
        item, doc, score = np.append(self.item, item), np.append(self.doc, doc), np.append(self.score, score)
        order = np.lexsort((doc, -score, item))
        item, doc, score = item[order], doc[order], score[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        self.least[item[rank == self.k - 1]] = score[rank == self.k - 1]
        keep = rank < self.k
        self.item, self.doc, self.score = item[keep], doc[keep], score[keep]


def score_into(heaps: Heaps, index: Index, weights: np.ndarray, n_docs: int, n_terms: int, batch: pa.RecordBatch) -> None:
    """Scores of a batch of documents for all items that share a term with them."""
    n_items = len(index.ids)
    lengths, term, count = flat(batch)
    ids, n = batch.column("_doc").to_numpy(), batch.column("_n").to_numpy()
    doc = np.repeat(np.arange(len(n)), lengths)
    m = 10 + 90 * n * n_docs // n_terms
    part = weights[term] * (1_000_000_000 * count // (1000 * count + 8 * m[doc]))
    holders = np.diff(index.starts)[term]
    sums = np.cumsum(np.bincount(doc, holders, len(n)).astype(np.int64))
    lo = 0
    while lo < len(n):
        done = int(sums[lo - 1]) if lo else 0
        hi = min(max(lo + 1, int(np.searchsorted(sums, done + CELLS))), lo + max(1, CELLS // n_items))
        own = slice(*np.searchsorted(doc, (lo, hi)))
        times = holders[own]
        place = np.repeat(index.starts[term[own]] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        score = np.zeros((hi - lo) * n_items, np.int64)
        np.add.at(score, np.repeat((doc[own] - lo) * n_items, times) + index.items[place], np.repeat(part[own], times))
        score = score.reshape(-1, n_items)
        row, item = np.nonzero(score >= heaps.least)
        heaps.push(item, ids[lo:hi][row], score[row, item])
        lo = hi


def rank(documents: DataFrame, items: DataFrame, k: int = 10, id_column="doc_id", text_column="text", item_column="item_id", item_text="text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents with the highest scores above 0 for each item.

    The items are the queries: their terms form an inverted index of bounded size, which is broadcast, and the documents, the large
    side, stream through it. A first pass counts each document's terms once, keeping those of the index; corpus counts are sums of
    these. Then every task adds a document's terms into the scores of their items and keeps the ``k`` best of each item in a heap;
    the heaps, of ``k`` rows an item and task, are merged, first in ``SALTS`` groups. No document is shuffled. More items than
    ``POSTINGS`` terms hold are searched in slices, a pass over the documents each. Whole numbers throughout, so order never matters.

    Null texts are empty and have no term; an empty text is no document of the counts, and an item without a term gets no row. Rows without an id count
    as documents but are not found; items without an id are left out. Rows that repeat an id are documents of their own, with a place
    each; rows that repeat an item's id are one item with the terms of all. Equal scores go by the smaller id. An empty table on either
    side gives an empty result; other columns, however named, are left out.
    """
    spark = documents.sparkSession
    kind = items.schema[item_column].dataType
    made = f"item_id {kind.simpleString()}, rank int, doc_id bigint, score bigint"
    docs = documents.select(F.col(id_column).cast("long").alias("_doc"), whole(text_column).cast("binary").alias("_text"))
    postings = written(item_terms(items, item_column, item_text), "search-postings")
    n, own = slices(postings)
    out = spark.createDataFrame([], made)
    for part in range(n):
        index = index_of(postings.where(own == part))
        if index.ids:
            out = out.unionByName(_search(docs, index, k, kind))
    return out


def _search(docs: DataFrame, index: Index, k: int, kind) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)
    found = written(counted(docs, shared), "search-counts")
    n_docs, n_terms, df = statistics(found, len(index.terms))
    weights = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
    arrow = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = Heaps(len(shared.value.ids), k)
        for batch in batches:
            score_into(heaps, shared.value, weights, n_docs, n_terms, batch)
        ids = pa.array(shared.value.ids, arrow).take(pa.array(heaps.item))
        yield pa.RecordBatch.from_arrays([ids, pa.array(heaps.doc), pa.array(heaps.score)], ["item_id", "doc_id", "score"])

    best = found.where("_doc IS NOT NULL").mapInArrow(run, f"item_id {kind.simpleString()}, doc_id bigint, score bigint")
    order = (F.desc("score"), "doc_id")
    some = Window.partitionBy("item_id", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).orderBy(*order)
    merged = best.withColumn("_rank", F.row_number().over(some)).where(F.col("_rank") <= k).drop("_rank")
    merged = merged.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).where(F.col("rank") <= k)
    return merged.select("item_id", "rank", "doc_id", "score")
