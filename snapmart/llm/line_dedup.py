"""Line dedup: overlapping documents aligned by patience diff, common blocks deleted from the later one."""

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from snapmart.llm.common import released, whole, written

#: Characters of a run of lines that can bring two documents together, and of a block that is deleted, at least.
CHARACTERS = 24
#: An odd factor of the hashes of runs, and its inverse modulo 2**64.
FACTOR = 0x9E3779B97F4A7C15
INVERSE = pow(FACTOR, -1, 2**64)
#: Other holders of a run that a document meets in the first round after the earliest, and times as many in each further round.
STEP = 8


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Matches (place in ``a``, place in ``b``) of a patience diff, in order.

    Lines that both have once, in the longest order they share, are matched; then equal neighbours of matches, and
    again the lines between matches, in which other lines may now occur once.
    """
    found: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        lo, hi, low, high = todo.pop()
        while lo < hi and low < high and a[lo] == b[low]:
            found.append((lo, low))
            lo, low = lo + 1, low + 1
        while lo < hi and low < high and a[hi - 1] == b[high - 1]:
            hi, high = hi - 1, high - 1
            found.append((hi, high))
        if lo >= hi or low >= high:
            continue
        once_a, once_b = Counter(a[lo:hi]), Counter(b[low:high])
        where = {line: j for j, line in enumerate(b[low:high], low) if once_b[line] == 1}
        pairs = [(i, where[line]) for i, line in enumerate(a[lo:hi], lo) if once_a[line] == 1 and line in where]
        if not pairs:
            continue
        # Longest increasing run of places in b: piles of patience sorting, each card pointing to the pile before.
        tops: list[int] = []
        cards: list[int] = []
        before: list[int] = []
        for k, (_, j) in enumerate(pairs):
            pile = bisect_left(tops, j)
            before.append(cards[pile - 1] if pile else -1)
            tops[pile:pile + 1] = [j]
            cards[pile:pile + 1] = [k]
        chain, k = [], cards[-1]
        while k >= 0:
            chain.append(pairs[k])
            k = before[k]
        chain.reverse()
        at, there = lo, low
        for i, j in chain:
            todo.append((at, i, there, j))
            at, there = i + 1, j + 1
        todo.append((at, hi, there, high))
        found += chain
    return sorted(found)


def common_blocks(later: list[int], earlier: list[int], places: list[int], sizes: list[int], least: int = CHARACTERS) -> list[int]:
    """Lines of ``later`` in blocks of consecutive matches with ``earlier`` that have ``least`` characters together.

    ``earlier`` may lack lines that ``later`` has not; ``places`` are where its lines stand in the whole document.
    """
    out: list[int] = []
    block: list[int] = []
    last = (-2, -2)
    for i, j in [*patience(later, earlier), (-1, -1)]:
        match = (i, places[j] if j >= 0 else -1)
        if match != (last[0] + 1, last[1] + 1):
            if sum(sizes[k] for k in block) >= least:
                out += block
            block = []
        block.append(i)
        last = match
    return out


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(c)) for c in ("_lines", "_shared", "_places", "_sizes")]
        # One pair at a time: lists of a whole batch can be large.
        gone = [common_blocks(*(c[k].as_py() for c in columns)) for k in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(gone, pa.list_(pa.int32()))], ["_doc", "_gone"])


def windows(sizes: np.ndarray, offsets: np.ndarray, least: int = CHARACTERS) -> tuple[np.ndarray, np.ndarray]:
    """(from, to): the shortest run of lines with ``least`` characters from each line on, and up to each line, inside each text.

    Every block of ``least`` characters consists of such runs, so texts without a common run have no common block.
    """
    total = np.append(0, np.cumsum(sizes, dtype=np.int64))
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = np.arange(len(sizes))
    to = np.searchsorted(total, total[:-1] + least)
    fits = to <= offsets[owner + 1]
    since = np.searchsorted(total, total[1:] - least, side="right") - 1
    back = since >= offsets[owner]
    found = np.unique(np.concatenate([np.column_stack([at[fits], to[fits]]), np.column_stack([since[back], at[back] + 1])]), axis=0)
    return found[:, 0], found[:, 1]


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of the shortest runs of lines that a block can consist of, by which documents meet, with the places they cover (from, to)."""
    for batch in batches:
        docs, lines, sizes = batch.columns
        sizes, hashes = (c.flatten().to_numpy(zero_copy_only=False) for c in (sizes, lines))
        offsets = lines.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        lo, hi = windows(sizes, offsets)
        # The hash of a run is the difference of two sums over all lines before, whatever its place.
        power, back = (np.cumprod(np.append(np.uint64(1), np.full(len(hashes), m, np.uint64))) for m in (FACTOR, INVERSE))
        sums = np.append(np.uint64(0), np.cumsum(hashes.astype(np.int64).view(np.uint64) * power[:-1]))
        keys = ((sums[hi] - sums[lo]) * back[lo] + (hi - lo).astype(np.uint64)).view(np.int64)
        owner = np.searchsorted(offsets, lo, side="right") - 1
        start = offsets[owner]
        yield pa.RecordBatch.from_arrays([docs.take(pa.array(owner)), pa.array(keys), pa.array((lo - start).astype(np.int32)), pa.array((hi - start).astype(np.int32))],
                                         ["_doc", "_key", "_from", "_to"])


def _open(done: float):
    """Rows of documents with the seeds that still cover a line not deleted and have holders that were not met yet, ``_gone`` brought up to date."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, lines, sizes, seeds, gone, more = batch.columns
            keep, left, deleted = [], [], []
            for k in range(batch.num_rows):
                out = {*gone[k].as_py(), *(more[k].as_py() or ())}
                found = [x for x in seeds[k].as_py() if x["_n"] > done and not out.issuperset(range(x["_from"], x["_to"]))]
                if found:
                    keep.append(k)
                    left.append(found)
                    deleted.append(sorted(out))
            keep = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([docs.take(keep), lines.take(keep), sizes.take(keep), pa.array(left, seeds.type), pa.array(deleted, gone.type)], batch.schema.names[:5])

    return run


def duplicate_lines(docs: DataFrame, id_column="doc_id", text_column="text") -> DataFrame:
    """``_id, _hash, _gone``: the lines (from 0) to delete of each document that loses any; _hash is that of its text.

    A document loses the lines that its alignment with any earlier document puts into a common block. Copies lose all lines at
    once and are nobody's partner, as the first of them has the same lines. Others meet the earliest holder of each shortest run of lines of
    ``CHARACTERS`` or more; those that keep a line of such a run then meet a sample of its other earlier holders, ``STEP`` times as many each
    round, until its lines go or all of them were met. So a line in a third of all documents mostly gives each of them one partner, not all pairs.
    Each pair is aligned on line hashes alone.
    """
    lines = F.split(F.col("_text"), "\n")
    rows = docs.select(F.col(id_column).alias("_id"), whole(text_column).alias("_text"))
    kind = dict(rows.dtypes)["_id"]
    narrow = rows.select("_id", F.xxhash64("_text").alias("_hash"), F.transform(lines, lambda x: F.xxhash64(F.rtrim(x))).alias("_lines"),
                         F.transform(lines, lambda x: F.length(F.trim(x))).alias("_sizes")).dropDuplicates(["_id", "_hash"])
    order = F.struct(F.col("_id").isNull().alias("_none"), "_id", "_hash")
    narrow = written(narrow.select(order.alias("_doc"), F.struct(F.xxhash64("_lines"), F.size("_lines")).alias("_body"), "_lines", "_sizes"), "line-hashes")

    first = narrow.groupBy("_body").agg(F.min("_doc").alias("_first"), F.max("_doc").alias("_last")).where("_first < _last").select("_body", "_first")
    chars = F.aggregate("_sizes", F.lit(0).cast("long"), lambda n, x: n + x)
    copies = written(narrow.select("_doc", "_body", chars.alias("_chars")).join(first, "_body").where("_first < _doc").select("_doc", F.col("_body.col2").alias("_n"), "_chars"), "line-copies")
    texts = narrow.join(copies.select("_doc"), "_doc", "left_anti").select("_doc", "_lines", "_sizes")
    found = [copies.where(F.col("_chars") >= CHARACTERS).select("_doc", F.sequence(F.lit(0), F.col("_n") - 1).alias("_gone"))]

    doc = f"struct<_none:boolean,_id:{kind},_hash:bigint>"
    seeds = texts.mapInArrow(released(_seeds), f"_doc {doc}, _key bigint, _from int, _to int")
    # Occurrences, no less than holders: runs that only one document has are dropped here.
    holders = seeds.groupBy("_key").agg(F.min("_doc").alias("_first"), F.max("_doc").alias("_last"), F.count(F.lit(1)).alias("_n")).where("_first < _last").drop("_last")
    shared = written(seeds.join(holders, "_key"), "line-seeds")
    own = shared.where("_first < _doc").groupBy("_doc").agg(F.collect_list(F.struct("_key", "_from", "_to", "_first", "_n")).alias("_seeds"))
    state = texts.join(own, "_doc").withColumn("_gone", F.array().cast("array<int>"))
    columns = f"_doc {doc}, _lines array<bigint>, _sizes array<int>, _seeds array<struct<_key:bigint,_from:int,_to:int,_first:{doc},_n:bigint>>, _gone array<int>"
    state = written(state.select("_doc", "_lines", "_sizes", "_seeds", "_gone"), "line-state")
    met = state.select("_doc", "_lines", "_sizes", F.explode(F.array_distinct(F.transform("_seeds", lambda x: x["_first"]))).alias("_other"))
    # Of a long early document that very many others share a line with, each pair gets the shared lines only.
    both = F.filter(F.transform("_lines2", lambda x, i: F.struct(x.alias("line"), i.alias("place"))), lambda x: F.array_contains("_lines", x["line"]))
    other = narrow.select(F.col("_doc").alias("_other"), F.col("_lines").alias("_lines2"))
    # A holder's place in the sample of a run: holders up to ``done`` were met.
    place = F.pmod(F.xxhash64("_doc", "_key"), F.lit(2**40)) / F.lit(2.0**40) * F.col("_n")
    done = 0.0
    while True:
        gone = (met.join(other, "_other").withColumn("_both", both)
                .select("_doc", "_lines", "_sizes", F.col("_both.line").alias("_shared"), F.col("_both.place").alias("_places"))
                .mapInArrow(released(_aligned), f"_doc {doc}, _gone array<int>").where(F.size("_gone") > 0)
                .groupBy("_doc").agg(F.array_distinct(F.flatten(F.collect_list("_gone"))).alias("_more")))
        gone = written(gone, "line-gone")
        found.append(gone.select("_doc", F.col("_more").alias("_gone")))
        state = written(state.join(gone, "_doc", "left").select(*state.columns, "_more").mapInArrow(released(_open(done)), columns), "line-state")
        if state.isEmpty():
            break
        upto = done * STEP or float(STEP)
        some = shared.where((place >= done) & (place < upto)).select("_key", F.col("_doc").alias("_other"))
        wanted = state.select("_doc", F.explode(F.array_distinct(F.transform("_seeds", lambda x: x["_key"]))).alias("_key"))
        pairs = wanted.join(some, "_key").where("_other < _doc").select("_doc", "_other").distinct()
        met, done = pairs.join(state.select("_doc", "_lines", "_sizes"), "_doc"), upto
    return (reduce(DataFrame.unionByName, found).groupBy("_doc").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("_gone")))).alias("_gone"))
            .select("_doc._id", "_doc._hash", "_gone"))


def dedup(docs: DataFrame, id_column="doc_id", text_column="text") -> DataFrame:
    """``docs`` with the deleted lines gone from the text, and ``lines, removed_lines``; columns of those names are replaced.

    Documents are in the order of their ids, null last, then of a hash of their texts. Null texts stay null and have one
    empty line; rows with equal id and text are one document and lose the same lines; a document that is a copy of an earlier one
    loses all its lines and has an empty text; an empty table gives an empty result. The line breaks between kept lines stay.
    """
    keep = [c for c in docs.columns if c not in ("lines", "removed_lines")]
    gone = written(duplicate_lines(docs, id_column, text_column), "line-matches").select(F.col("_id").alias("_gone_id"), F.col("_hash").alias("_gone_hash"), "_gone")
    keyed = docs.select(*keep).withColumn("_gone_hash", F.xxhash64(whole(text_column)))
    # What is deleted grows with the corpus, so texts meet it in a merge join at every size.
    joined = keyed.join(gone.hint("merge"), keyed[id_column].eqNullSafe(gone["_gone_id"]) & (keyed["_gone_hash"] == gone["_gone_hash"]), "left")
    lines = F.split(F.col(text_column), "\n")
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("_gone", i)), "\n")
    return joined.select(*[F.when(F.col("_gone").isNull(), F.col(c)).otherwise(kept).alias(c) if c == text_column else keyed[c] for c in keep],
                         F.size(F.split(whole(text_column), "\n")).cast("long").alias("lines"),
                         F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("removed_lines"))
