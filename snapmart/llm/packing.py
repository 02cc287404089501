"""Best-fit packing of documents into sequences by a grouping genetic algorithm on islands."""

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from snapmart.llm.common import in_parts, released, whole, written
from snapmart.session import stage

LENGTH = 2048
#: Pieces that are packed together. Fewer waste more at the last bin of each part, more take longer to improve.
PART = 16_000
ISLANDS = 3
ROUNDS = 2
GENERATIONS = 6
POPULATION = 4
#: Words, and parts of words, whose ids a Python worker remembers at most.
REMEMBERED = 450_000
# Characters that Python parts words by and the tokenizer doesn't.
_ODD_SPACE = re.compile("[\x1c-\x1f]")
# Words of these characters only are lowered and parted by Python as by the tokenizer: printable ASCII and the Latin letters
# that are one code point in either case.
_PLAIN = re.compile("[!-~\u00c0-\u012f\u0131-\u0148\u014a-\u017e]+")
# Fixed value: the parts of a word that the tokenizer's file asks for, for such words.
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
_tokenizers: dict = {}


class Remembered(dict):
    """Results of a function; when full, new ones are made each time."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        value = self.make(key)
        if len(self) < REMEMBERED:
            self[key] = value
        return value


def _encoder(path: str):
    """Ids of a text as little-endian unsigned 32-bit bytes.

    White space is dropped and no token reaches over it, so a text's ids are those of its words one after the other;
    words repeat, and their lowered parts repeat more. A text with separators that Python and the tokenizer see differently
    is encoded as a whole, and so is a word of other characters.
    """
    if path not in _tokenizers:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)

        def ids(text: str) -> bytes:
            return np.asarray(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

        parts = Remembered(ids)

        def word_ids(word: str) -> bytes:
            if _PLAIN.fullmatch(word) and "<|" not in word:
                return b"".join([parts[part] for part in _PARTS.findall(word.lower())])
            return ids(word)

        words = Remembered(word_ids)
        _tokenizers[path] = lambda text: ids(text) if _ODD_SPACE.search(text) else b"".join(map(words.__getitem__, text.split()))
    return _tokenizers[path]


def pieces(docs: DataFrame, tokenizer: str, id_column="doc_id", text_column="text", length: int = LENGTH) -> DataFrame:
    """Pieces of documents: ``_id, piece, start, length, ids_crc32``. A document's ids end with id 0; only longer ones are cut."""
    width = 4 * length

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer)
        for batch in batches:
            out: tuple = ([], [], [], [], [])
            for row, text in enumerate(in_parts(batch.column(1))):
                data = encode(text) + b"\0\0\0\0"
                for piece, at in enumerate(range(0, len(data), width)):
                    part = data[at:at + width]
                    for column, value in zip(out, (row, piece, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        column.append(value)
            taken = batch.column(0).take(pa.array(out[0], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [taken, pa.array(out[1], pa.int32()), *(pa.array(x, pa.int64()) for x in out[2:])], ["_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(id_column).alias("_id"), whole(text_column).alias("_text"))
    kind = dict(rows.dtypes)["_id"]
    return rows.mapInArrow(released(cut), f"_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_fit(items, sizes: list[int], room: dict[int, int], bin_of: np.ndarray, next_bin: int, capacity: int) -> int:
    """Puts each item into the bin with the least room that takes it, or a new one; returns the number of the next new bin.

    Bins are kept by their room; the bits of an integer tell which rooms there are.
    """
    by_room: dict[int, list[int]] = {}
    there = 0
    for number, left in room.items():
        if left:
            by_room.setdefault(left, []).append(number)
            there |= 1 << left
    for item in items:
        size = sizes[item]
        fitting = there >> size
        if fitting:
            left = size + (fitting & -fitting).bit_length() - 1
            stack = by_room[left]
            number = stack.pop()
            if not stack:
                there ^= 1 << left
        else:
            left, number = capacity, next_bin
            next_bin += 1
        bin_of[item] = number
        if left := left - size:
            if there >> left & 1:
                by_room[left].append(number)
            else:
                by_room[left] = [number]
                there |= 1 << left
    return next_bin


def numbered(bin_of: np.ndarray) -> np.ndarray:
    return np.unique(bin_of, return_inverse=True)[1].astype(np.int32)


def fitness(bin_of: np.ndarray, sizes: np.ndarray, capacity: int) -> float:
    """Fewer bins first, then unevenly filled ones, which leave room for more."""
    fill = np.bincount(bin_of, weights=sizes) / capacity
    return -len(fill) + float((fill**2).mean())


def cross(a: np.ndarray, b: np.ndarray, sizes: np.ndarray, plain: list[int], capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Grouping crossover: whole well-filled bins of ``b`` come into ``a``.

    Bins of ``a`` that hold one of the injected items are emptied, and their other items, together with those
    of some badly filled bins, are placed by best fit, larger ones first or in a disturbed order.
    """
    fill_b = np.bincount(b, weights=sizes)
    draw = rng.random(len(fill_b)) * (fill_b >= np.quantile(fill_b, 0.5)) < rng.uniform(0.05, 0.4)
    well = draw & (fill_b >= np.quantile(fill_b, 0.5))
    injected = well[b]
    fill_a = np.bincount(a, weights=sizes)
    emptied = (fill_a < capacity) & (rng.random(len(fill_a)) < (1 - fill_a / capacity) * 4)
    emptied[a[injected]] = True
    displaced = np.flatnonzero(emptied[a] & ~injected)
    child = a.copy()
    child[injected] = len(fill_a) + b[injected]
    first_new = len(fill_a) + len(fill_b)
    room = dict(zip(np.flatnonzero(~emptied).tolist(), (capacity - fill_a[~emptied]).astype(int).tolist(), strict=True))
    room |= dict(zip((len(fill_a) + np.flatnonzero(well)).tolist(), (capacity - fill_b[well]).astype(int).tolist(), strict=True))
    order = np.argsort(-sizes[displaced] * rng.uniform(1 - rng.choice([0, 0.02, 0.2]), 1, len(displaced)), kind="stable")
    best_fit(displaced[order].tolist(), plain, room, child, first_new, capacity)
    return numbered(child)


def evolve(population: list[np.ndarray], sizes: np.ndarray, capacity: int, generations: int, size: int, rng: np.random.Generator) -> list[np.ndarray]:
    """An island's generations; the population comes back best first."""
    plain = sizes.tolist()
    least = math.ceil(sizes.sum() / capacity)
    while len(population) < size:
        order = np.argsort(-sizes * rng.uniform(1 - 0.05 * len(population), 1, len(sizes)), kind="stable")
        fresh = np.zeros(len(sizes), np.int32)
        best_fit(order.tolist(), plain, {}, fresh, 0, capacity)
        population.append(numbered(fresh))
    scored = sorted(((fitness(p, sizes, capacity), i, p) for i, p in enumerate(population)), key=lambda x: (-x[0], x[1]))[:size]
    born = len(population)
    for _ in range(generations):
        if scored[0][2].max(initial=-1) + 1 <= least:
            break
        for _ in range(size):
            a, b = sorted(rng.integers(0, len(scored), 2))
            child = cross(scored[a][2], scored[b if a != b else (a + 1) % len(scored)][2], sizes, plain, capacity, rng)
            scored.append((fitness(child, sizes, capacity), born, child))
            born += 1
        scored = sorted(scored, key=lambda x: (-x[0], x[1]))[:size]
    return [p for _, _, p in scored]


def solve(parts: DataFrame, capacity: int = LENGTH, islands=ISLANDS, rounds=ROUNDS, generations=GENERATIONS, size=POPULATION) -> DataFrame:
    """Packs each row of ``parts`` (_part, _sizes: binary int32): ``_part, _bins``, a bin number for each size.

    Every part lives on several islands. Each round, an island's generations run in one task; then its elite moves on to
    the next island. Seeds come from part, island and round, so a task that runs again gives the same.
    """
    def island_round(turn: int):
        def run(key, rows: pd.DataFrame) -> pd.DataFrame:
            rng = np.random.default_rng([key[0] % 2**32, key[1], turn])
            sizes = np.frombuffer(rows["_sizes"].iloc[0], np.int32).astype(np.int64)
            members = sorted({bytes(b) for b in rows["_bins"] if b is not None})
            found = evolve([np.frombuffer(b, np.int32) for b in members], sizes, capacity, generations, size, rng)
            return pd.DataFrame({"_part": key[0], "_island": key[1], "_sizes": rows["_sizes"].iloc[0], "_rank": range(len(found)),
                                 "_fitness": [fitness(p, sizes, capacity) for p in found], "_bins": [p.astype(np.int32).tobytes() for p in found]})
        return run

    schema = "_part bigint, _island int, _sizes binary, _rank int, _fitness double, _bins binary"
    people = parts.select("_part", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("_island"), "_sizes", F.lit(None).cast("binary").alias("_bins"))
    for turn in range(rounds):
        if turn:
            elite = people.where("_rank = 0").withColumn("_island", (F.col("_island") + 1) % islands)
            people = people.unionByName(elite).select("_part", "_island", "_sizes", "_bins")
        people = stage(people.groupBy("_part", "_island").applyInPandas(island_round(turn), schema))
    best = F.max_by("_bins", F.struct("_fitness", -F.col("_island")))
    return people.where("_rank = 0").groupBy("_part").agg(best.alias("_bins"))


def pack(docs: DataFrame, tokenizer: str, id_column="doc_id", text_column="text", length: int = LENGTH, part: int = PART) -> DataFrame:
    """Sequences of at most ``length`` tokens: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Pieces that fill a sequence are one; the others are dealt at random into parts of about ``part`` pieces, and each part
    is packed on its own by ``solve``. The last sequence of a part is all that parts waste. Null and empty texts are one
    token (id 0); repeated rows are packed as often as they occur; an empty table gives an empty result; other
    columns are left out.
    """
    cut = written(pieces(docs, tokenizer, id_column, text_column, length).withColumn("_row", F.monotonically_increasing_id()), "packing-pieces")
    full = cut.where(F.col("length") == length).withColumn("sequence_id", -1 - F.col("_row")).withColumn("offset", F.lit(0).cast("long"))
    open_ = cut.where(F.col("length") < length)
    dealt = open_.withColumn("_part", F.pmod(F.xxhash64("_row"), F.lit(max(1, math.ceil(open_.count() / part)))).cast("long"))

    def sizes(key, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"_part": [key[0]], "_sizes": [np.sort(rows["length"].to_numpy())[::-1].astype(np.int32).tobytes()]})

    solved = solve(dealt.select("_part", "length").groupBy("_part").applyInPandas(sizes, "_part bigint, _sizes binary"), length)

    def place(key, rows: pd.DataFrame, best: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "_row"], ascending=[False, True], kind="stable")
        rows["sequence_id"] = key[0] * 2**32 + np.frombuffer(best["_bins"].iloc[0], np.int32).astype(np.int64)
        rows["offset"] = rows.groupby("sequence_id")["length"].cumsum() - rows["length"]
        return rows[["_row", "sequence_id", "offset"]]

    places = dealt.select("_part", "_row", "length").groupBy("_part").cogroup(solved.groupBy("_part")).applyInPandas(
        place, "_row bigint, sequence_id bigint, offset bigint")
    placed = open_.join(places, "_row").drop("_row")
    columns = ["piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return full.select("_id", *columns).unionByName(placed).select(F.col("_id").alias(id_column), *columns)
