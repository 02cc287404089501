"""Suffix-array dedup by prefix-free parsing: long strings that start at several places of a corpus."""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from snapmart.llm.common import whole, written
from snapmart.llm.parsing import LENGTH, Hashes, runs

#: Bytes that are parsed at once, and windows of a piece of a longer text.
CHUNK, PIECE = 1 << 16, 1 << 20
#: Different phrases of one core whose windows are compared in one task; more go through hashes of their windows.
TOGETHER = 2000


def _pieces(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Chunks of texts: the bytes, starts and ends of pieces, the text each piece is of, and its place there.

    Pieces of a long text overlap by a window less a byte, so that every window is in one of them.
    """
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def packed():
        ends = np.cumsum([len(p) for _, _, p in held])
        return (np.frombuffer(b"".join(p for _, _, p in held), np.uint8), ends - np.array([len(p) for _, _, p in held]), ends,
                np.array([k for k, _, _ in held]), np.array([at for _, at, _ in held]))

    for k, text in enumerate(texts):
        for at in range(0, max(len(text) - LENGTH + 1, 0), PIECE):
            held.append((k, at, text[at:at + PIECE + LENGTH - 1]))
            size += len(held[-1][2])
            if size >= CHUNK:
                yield packed()
                held, size = [], 0
    if held:
        yield packed()


def _parsed(texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of windows: text, first and last window in the text, keys of the core and of the whole phrase, bytes before the core."""
    for data, starts, ends, text, place in _pieces(texts):
        piece, first, last, core, core_end = runs(data, starts, ends)
        if len(piece):
            hashes = Hashes(data)
            # The keys come from independent sums, and a phrase's key counts only together with that of its core.
            yield (text[piece], first - starts[piece] + place[piece], last - starts[piece] + place[piece], hashes.of(0, core, core_end),
                   hashes.of(1, first, last + LENGTH) ^ (core - first), core - first)


def _bytes(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return batch.column(column).cast(pa.binary()).to_pylist()


def _cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, _, core, _, _ in _parsed(_bytes(batch, 0)):
            yield pa.RecordBatch.from_arrays([pa.array(core)], ["_core"])


def _phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for text, first, last, core, phrase, before in _parsed(_bytes(batch, 2)):
            rows = pa.array(text)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(core), pa.array(phrase),
                                              pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)), pa.array(before.astype(np.int16))],
                                             ["_id", "_hash", "_core", "_phrase", "_first", "_last", "_before"])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the phrases in ``_wanted``, with all that their windows reach."""
    for batch in batches:
        out: tuple = ([], [], [], [], [], [])
        for row, (text, wanted) in enumerate(zip(_bytes(batch, 2), batch.column(3).to_pylist(), strict=True)):
            for w in wanted:
                for column, value in zip(out, (row, w["_core"], w["_first"], w["_before"], w["_single"], text[w["_first"]:w["_last"] + LENGTH]), strict=True):
                    column.append(value)
        rows = pa.array(out[0], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.int16()),
             pa.array(out[4], pa.bool_()), pa.array(out[5], pa.binary())], ["_id", "_hash", "_core", "_first", "_before", "_single", "_bytes"])


def _shared(one: bytes, two: bytes) -> int:
    """Bytes at the start that are equal."""
    n = min(len(one), len(two))
    if one[:n] == two[:n]:
        return n
    return int((np.frombuffer(one, np.uint8, n) != np.frombuffer(two, np.uint8, n)).argmax())


def _sorted(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The order of strings, and the bytes that each shares with the one before it."""
    order = sorted(range(len(strings)), key=strings.__getitem__)
    return np.array(order), np.array([0, *(_shared(strings[a], strings[b]) for a, b in zip(order, order[1:], strict=False))])


def equal_windows(phrases: list[tuple[int, bytes]]) -> list[tuple[int, int] | None]:
    """For each phrase of a core (bytes before the core, bytes with all that its windows reach), the first and the last of its windows that another has too.

    The suffixes that begin with the core are sorted, and so is what precedes them, read backwards. A window so many bytes before the core is equal in
    two phrases that share as many bytes backwards and the rest of the window forwards, so both orders fall into classes wherever neighbours
    share less. Classes change only at the distances where two neighbours part. A run's windows all overlap, so what lies
    between two repeated ones is covered too.
    """
    back, forth = [p[:before][::-1] for before, p in phrases], [p[before:before + LENGTH] for before, p in phrases]
    if len(phrases) == 2:
        least, most = LENGTH - _shared(*forth), _shared(*back)
        return [(before - most, before - least) if least <= most else None for before, _ in phrases]
    (by_back, backwards), (by_forth, forwards) = _sorted(back), _sorted(forth)
    least, most = LENGTH - int(forwards.max()), int(backwards.max())
    n = len(phrases)
    nearest, farthest = np.full(n, LENGTH), np.full(n, -1)
    if least <= most:
        turns = np.unique(np.concatenate([LENGTH - forwards, backwards + 1, [least, most + 1]]))
        turns = turns[(turns >= least) & (turns <= most + 1)]
        kinds = np.empty((2, n), np.int64)
        for distance, after in zip(turns[:-1].tolist(), turns[1:].tolist(), strict=True):
            kinds[0, by_back] = np.cumsum(backwards < distance)
            kinds[1, by_forth] = np.cumsum(forwards < LENGTH - distance)
            _, which, count = np.unique(kinds[0] * (n + 1) + kinds[1], return_inverse=True, return_counts=True)
            hit = count[which] > 1
            nearest[hit] = np.minimum(nearest[hit], distance)
            farthest[hit] = after - 1
    return [(before - b, before - a) if a <= b else None for (before, _), a, b in zip(phrases, nearest.tolist(), farthest.tolist(), strict=True)]


def _ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated windows of single phrases, from contexts sorted by core; a core's rows may span batches."""

    def done(rows: list[dict]) -> list[tuple]:
        if len(rows) < 2:
            return []
        spans = equal_windows([(r["_before"], r["_bytes"]) for r in rows])
        return [(r["_id"], r["_hash"], r["_first"] + w[0], r["_first"] + w[1] + LENGTH) for r, w in zip(rows, spans, strict=True) if r["_single"] and w]

    def emit(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found, strict=True)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), *(pa.array(c, pa.int32()) for c in columns[2:])],
                                          ["_id", "_hash", "_start", "_end"])

    held: list[dict] = []
    for batch in batches:
        found: list[tuple] = []
        for row in batch.to_pylist():
            if held and held[0]["_core"] != row["_core"]:
                found += done(held)
                held = []
            held.append(row)
        yield emit(found)
    yield emit(done(held))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of all windows of the phrases."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 500):
            part = batch.slice(lo, 500)
            data = _bytes(part, part.schema.get_field_index("_bytes"))
            count = np.array([len(b) - LENGTH + 1 for b in data])
            size = np.array([len(b) for b in data])
            row = np.repeat(np.arange(len(data)), count)
            inside = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            at = inside + (np.cumsum(size) - size)[row]
            hashes = Hashes(np.frombuffer(b"".join(data), np.uint8))
            one, two = (hashes.of(k, at, at + LENGTH) for k in range(2))
            rows = pa.array(row)
            start = part.column(part.schema.get_field_index("_first")).to_numpy()[row] + inside
            yield pa.RecordBatch.from_arrays([part.column(0).take(rows), part.column(1).take(rows), part.column(part.schema.get_field_index("_single")).take(rows),
                                              pa.array(one), pa.array(two), pa.array(start.astype(np.int32))], ["_id", "_hash", "_single", "_one", "_two", "_start"])


def repeats(docs: DataFrame) -> DataFrame:
    """``_id, _hash, _spans``: the spans of bytes of texts (_id, _hash, _text) that are covered by repeated windows.

    1. Rolling-hash triggers cut texts into phrases. Cores (half a window at a trigger) that occur once are out: nothing
       that reaches over them is repeated.
    2. The others' phrases are the dictionary. A phrase that occurs again with all that its windows reach is repeated whole.
    3. Different phrases of one core are compared by the sorted order of their suffixes with what follows, and of what precedes. One of each phrase
       stands for all, so copies cost nothing here. Cores with very many phrases go through keys of their windows instead.
    """
    cores = docs.select("_text").mapInArrow(_cores, "_core bigint").groupBy("_core").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_core")
    cores = written(cores, "repeat-cores")
    kinds = "_id bigint, _hash bigint, "
    near = docs.select("_id", "_hash", "_text").mapInArrow(_phrases, kinds + "_core bigint, _phrase bigint, _first int, _last int, _before smallint").join(cores, "_core")
    near = written(near, "repeat-phrases")
    phrases = near.groupBy("_core", "_phrase").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct("_id", "_hash", "_first", "_last", "_before")).alias("_one"))
    phrases = written(phrases.select("_core", "_phrase", "_n", "_one"), "repeat-dictionary")
    full = near.join(phrases.where("_n > 1").select("_core", "_phrase"), ["_core", "_phrase"]).select("_id", "_hash", F.col("_first").alias("_start"), (F.col("_last") + LENGTH).alias("_end"))
    several = (phrases.groupBy("_core").agg(F.count(F.lit(1)).alias("_phrases"), F.max((F.col("_n") == 1).cast("int")).alias("_open"))
               .where("_phrases > 1 and _open = 1").select("_core", (F.col("_phrases") > TOGETHER).alias("_many")))
    wanted = (phrases.join(several, "_core").select("_one._id", "_one._hash", "_many", F.struct("_core", "_one._first", "_one._last", "_one._before", (F.col("_n") == 1).alias("_single")).alias("_w"))
              .groupBy("_id", "_hash", "_many").agg(F.collect_list("_w").alias("_wanted")))
    wanted = written(wanted, "repeat-wanted")

    def contexts(of: Column) -> DataFrame:
        found = docs.join(wanted.where(of).drop("_many"), ["_id", "_hash"]).select("_id", "_hash", "_text", "_wanted")
        return found.mapInArrow(_contexts, kinds + "_core bigint, _first int, _before smallint, _single boolean, _bytes binary")

    spans = kinds + "_start int, _end int"
    some = contexts(~F.col("_many")).repartition("_core").sortWithinPartitions("_core").mapInArrow(_ordered, spans)
    keyed = contexts(F.col("_many")).mapInArrow(_windows, kinds + "_single boolean, _one bigint, _two bigint, _start int")
    again = keyed.groupBy("_one", "_two").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_one", "_two")
    many = keyed.where("_single").join(again, ["_one", "_two"]).select("_id", "_hash", "_start", (F.col("_start") + LENGTH).alias("_end"))
    return full.union(some).union(many).groupBy("_id", "_hash").agg(F.collect_list(F.struct("_start", "_end")).alias("_spans"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: tuple = ([], [], [], [], [])
        for text, spans in zip(_bytes(batch, batch.num_columns - 2), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
            merged: list[list[int]] = []
            for s in sorted((s["_start"], s["_end"]) for s in spans or ()):
                if merged and s[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s[1])
                else:
                    merged.append([*s])
            at, kept = 0, []
            for start, end in merged:
                kept.append(text[at:start])
                at = end
            rest = b"".join([*kept, text[at:]])
            for column, value in zip(out, (len(text), len(text) - len(rest), len(merged), hashlib.sha256(rest).hexdigest(), rest), strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.string()), pa.array(out[4], pa.binary())],
                                         [*batch.schema.names[:-2], "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def dedup(docs: DataFrame, id_column="doc_id", text_column="text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` (the bytes that stay, perhaps not whole characters).

    Every byte goes that is covered by a string of ``LENGTH`` bytes which also starts anywhere else in the table, in the same text
    too; matches never cross documents and overlaps count. Null texts are empty; texts shorter than a window stay; rows that
    repeat are documents like others, so both lose everything that is long enough; an empty table gives an empty
    result; other columns are left out.
    """
    text = whole(text_column)
    rows = docs.select(F.col(id_column).alias("_own"), F.coalesce(F.col(id_column).cast("long"), F.lit(0)).alias("_id"), F.xxhash64(text).alias("_hash"), text.alias("_text"))
    found = repeats(rows.select("_id", "_hash", "_text"))
    kind = dict(rows.dtypes)["_own"]
    joined = rows.join(found, ["_id", "_hash"], "left").select("_own", "_text", "_spans")
    done = joined.mapInArrow(_cut, f"_own {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
    return done.withColumnRenamed("_own", id_column)
