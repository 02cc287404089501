"""Language identification: unigrams over pieces of a fixed vocabulary, with the likelihoods of all segmentations of a text summed."""

import base64
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from snapmart.llm.common import whole, written
from snapmart.llm.quality import chunks

#: Learning documents of a language that the model is fitted on, about, those with the smallest hashes of their ids.
SAMPLE = 2000
#: Bytes of the longest pieces that are used: what an unsigned 64-bit number holds.
LONGEST = 8
#: Bytes of a run that is segmented at once: longer words are runs of this length, so that no product of probabilities gets too small.
RUN = 24
ROUNDS = 4
#: Occurrences that every piece is taken to have had besides those that were met.
SMOOTHING = 0.01
#: Scored words, and their bytes, that a task remembers at most.
REMEMBERED = 200_000
REMEMBERED_BYTES = 1 << 24
UNKNOWN = "und"

_OTHER = bytes(c for c in range(128) if not 97 <= c <= 122)
_LETTERS = bytes.maketrans(_OTHER, b" " * len(_OTHER))


class Vocabulary(NamedTuple):
    """Pieces by their bytes: ``keys[l]`` are those of length l as big-endian numbers in order, ``ids[l]`` their numbers."""

    keys: list
    ids: list
    size: int


class Model(NamedTuple):
    """Probabilities of pieces (rows; the last row, of zeros, is no piece) in languages (columns), and the languages' log shares."""

    vocabulary: Vocabulary
    languages: list
    pieces: np.ndarray
    prior: np.ndarray


def vocabulary(path: str) -> Vocabulary:
    """The pieces of a byte-level vocabulary (a line each: base64, rank) that can occur in words, and all single bytes but zero."""
    with open(path, "rb") as lines:
        pieces = {base64.b64decode(line.split()[0]) for line in lines}
    pieces = sorted({p for p in pieces if len(p) <= LONGEST and re.fullmatch(rb" ?[a-z\x80-\xff]*", p)} | {bytes([b]) for b in range(1, 256)})
    keys, ids = [[] for _ in range(LONGEST + 1)], [[] for _ in range(LONGEST + 1)]
    for i, p in enumerate(pieces):
        keys[len(p)].append(int.from_bytes(p, "big"))
        ids[len(p)].append(i)
    return Vocabulary([np.array(k, np.uint64) for k in keys], [np.array(i, np.int64) for i in ids], len(pieces))


def words(text: str) -> list[bytes]:
    """The words of a text: lower-case ASCII letters and everything beyond ASCII; all other characters part them."""
    return text.lower().encode("utf-8", "replace").translate(_LETTERS).split()


def runs(word: bytes) -> list[bytes]:
    """A word, led by a space, in runs of at most ``RUN`` bytes."""
    word = b" " + word
    return [word[i:i + RUN] for i in range(0, len(word), RUN)]


def lattice(block: np.ndarray, known: Vocabulary) -> list[np.ndarray]:
    """For runs of one length (rows of bytes): the numbers of the pieces of length l (from 1) that start at each byte; ``known.size`` where none does."""
    out, keys = [], np.zeros((len(block), block.shape[1] + 1), np.uint64)
    for length in range(1, min(LONGEST, block.shape[1]) + 1):
        keys = (keys[:, :-1] << np.uint64(8)) | block[:, length - 1:]
        at = np.minimum(np.searchsorted(known.keys[length], keys), max(0, len(known.keys[length]) - 1))
        out.append(np.where(known.keys[length][at] == keys, known.ids[length][at], known.size) if len(known.keys[length]) else np.full(keys.shape, known.size))
    return out


def forward(found: list[np.ndarray], p: np.ndarray, width: int) -> list[np.ndarray]:
    """For each byte, and the end: the summed probability of all segmentations of what lies before it."""
    alpha = [np.ones((len(found[0]), p.shape[1]))]
    for t in range(1, width + 1):
        alpha.append(sum(alpha[t - length] * p[found[length - 1][:, t - length]] for length in range(1, min(len(found), t) + 1)))
    return alpha


def expected(found: list[np.ndarray], p: np.ndarray, width: int, counts: np.ndarray) -> np.ndarray:
    """How often each piece is expected in runs that occur ``counts`` times, over all segmentations. ``p`` has one column."""
    alpha = forward(found, p, width)
    beta = [np.empty(0)] * width + [(counts / alpha[width][:, 0])[:, None]]
    out = np.zeros(len(p))
    for t in range(width - 1, -1, -1):
        edges = [(found[length - 1][:, t], p[found[length - 1][:, t]] * beta[t + length]) for length in range(1, min(len(found), width - t) + 1)]
        for piece, after in edges:
            out += np.bincount(piece, (alpha[t] * after)[:, 0], len(p))
        beta[t] = sum(after for _, after in edges)
    return out


def by_length(units: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(numbers, bytes) of the units of each length."""
    sizes = np.fromiter(map(len, units), np.int64, len(units))
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, np.frombuffer(b"".join(units[i] for i in rows), np.uint8).reshape(len(rows), size)


def log_likelihoods(units: list[bytes], model: Model) -> np.ndarray:
    """Log probability of each run in each language."""
    out = np.empty((len(units), model.pieces.shape[1]))
    for rows, block in by_length(units):
        out[rows] = np.log(forward(lattice(block, model.vocabulary), model.pieces, block.shape[1])[-1])
    return out


def held_out(id_column):
    return F.coalesce(F.crc32(id_column.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, known: Vocabulary, language="lang", id_column="doc_id", text_column="text", sample: int = SAMPLE) -> Model:
    """Piece probabilities of each language by expectation maximisation over all segmentations.

    About ``sample`` documents of each language are learned from: those whose hashed id falls below the share that gives so many. Their words are
    counted by language as a table; each round is a job over that table, whose tasks sum expected piece counts. The driver holds
    one number for each language and piece.
    """
    spark = docs.sparkSession
    learn = docs.where(F.col(language).isNotNull() & ~held_out(F.col(id_column))).select(F.col(language).cast("string").alias("_lang"), F.col(id_column).alias("_id"), whole(text_column).alias("_text"))
    sizes = {r["_lang"]: r["count"] for r in learn.groupBy("_lang").count().collect()}
    languages = sorted(sizes)
    share = np.array([sizes[x] for x in languages], float)
    prior = np.log(share / share.sum()) if languages else share
    if not languages:
        return Model(known, [], np.zeros((known.size + 1, 0)), prior)
    table = spark.createDataFrame([(x, i, min(1.0, sample / sizes[x])) for i, x in enumerate(languages)], "_lang string, _no int, _share double")
    chance = F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) / float(1 << 30)
    taken = learn.join(F.broadcast(table), "_lang").where(chance < F.col("_share")).select("_no", "_text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            met = Counter()
            for no, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                met.update((no, run) for word in words(text) for run in runs(word))
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in met], pa.int32()), pa.array([k[1] for k in met], pa.binary()), pa.array(list(met.values()), pa.int64())], ["_no", "_run", "_n"])

    counts = written(taken.mapInArrow(count, "_no int, _run binary, _n bigint").groupBy("_no", "_run").agg(F.sum("_n").alias("_n")), "language-words")
    pieces = np.full((known.size + 1, len(languages)), 1 / known.size)
    pieces[-1] = 0
    for _ in range(ROUNDS):
        pieces = _maximised(_expected_counts(counts, Model(known, languages, pieces, prior)))
    return Model(known, languages, pieces, prior)


def _expected_counts(counts: DataFrame, model: Model) -> np.ndarray:
    """Expected counts of pieces (rows) in languages (columns): one round over all counted runs."""
    shared = counts.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, languages, p, _ = shared.value
        sums = np.zeros(p.shape)
        for batch in batches:
            language, n = batch.column("_no").to_numpy(), batch.column("_n").to_numpy().astype(float)
            units = batch.column("_run").to_pylist()
            for no in np.unique(language):
                of = np.flatnonzero(language == no)
                for rows, block in by_length([units[i] for i in of]):
                    sums[:, no] += expected(lattice(block, known), p[:, [no]], block.shape[1], n[of[rows]])
        piece, no = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(no), pa.array(sums[piece, no])], ["_piece", "_no", "_n"])

    total = counts.mapInArrow(run, "_piece bigint, _no bigint, _n double").groupBy("_piece", "_no").agg(F.sum("_n").alias("_n")).toArrow()
    out = np.zeros(model.pieces.shape)
    out[total.column("_piece").to_numpy(), total.column("_no").to_numpy()] = total.column("_n").to_numpy()
    return out


def _maximised(counts: np.ndarray) -> np.ndarray:
    # Rounded, as sums of tasks come in any order: a fit that is run again is the same.
    out = np.round(counts, 6) + SMOOTHING
    out[-1] = 0
    return out / out.sum(axis=0)


class Scorer:
    """Log likelihoods of texts, with those of words remembered."""

    def __init__(self, model: Model):
        self.model, self.place, self.held = model, {}, 0
        self.table = np.empty((0, len(model.languages)))

    def _learn(self, met: dict) -> None:
        """Makes ``place`` and ``table`` hold all words of ``met``."""
        new = [w for w in met if w not in self.place]
        if len(self.place) + len(new) > REMEMBERED or self.held + sum(map(len, new)) > REMEMBERED_BYTES:
            self.place, self.held, self.table, new = {}, 0, self.table[:0], list(met)
        if not new:
            return
        parts = [runs(w) for w in new]
        lengths = np.array([len(p) for p in parts])
        each = np.vstack([log_likelihoods([r for p in parts[lo:lo + 8192] for r in p], self.model) for lo in range(0, len(parts), 8192)])
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new)), strict=True))
        self.held += sum(map(len, new))
        self.table = np.vstack([self.table, np.add.reduceat(each, np.cumsum(lengths) - lengths)])

    def __call__(self, texts: list[str]) -> np.ndarray:
        own = [words(t) for t in texts]
        flat = [w for x in own for w in x]
        doc = np.repeat(np.arange(len(own)), [len(x) for x in own])
        out = np.zeros((len(texts), len(self.model.languages)))
        self._learn(dict.fromkeys(flat))
        for lo in range(0, len(flat), 1 << 18):
            ids = np.fromiter(map(self.place.__getitem__, flat[lo:lo + (1 << 18)]), np.int64)
            np.add.at(out, doc[lo:lo + (1 << 18)], self.table[ids])
        return out


def predict(scorer: Scorer, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """The likeliest language of each text and its posterior probability; texts without a letter have none."""
    letters = np.array([any(map(str.isalpha, t)) for t in texts], bool)
    if not scorer.model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    log = scorer(texts) + scorer.model.prior
    best = log.argmax(axis=1)
    score = 1 / np.exp(log - log.max(axis=1, keepdims=True)).sum(axis=1)
    return [scorer.model.languages[b] if any_ else UNKNOWN for b, any_ in zip(best, letters, strict=True)], np.where(letters, score, 0.0)


def classify(docs: DataFrame, path: str, language="lang", id_column="doc_id", text_column="text", sample: int = SAMPLE, keep=None) -> DataFrame:
    """``docs`` with ``held_out, lang_pred, score``.

    Every language has its own probabilities of the pieces of one fixed vocabulary. The probability of a word is the sum over all its
    segmentations, by the forward algorithm over a lattice of pieces; single bytes are pieces, so nothing is without a segmentation.
    A text's is the product of its words' (lower case; what is neither an ASCII letter nor beyond ASCII parts words); words of more than ``RUN`` bytes count
    as runs of so many. ``lang_pred`` is the learned language of the largest posterior, ``score`` that posterior. Only texts are inputs of it.

    Texts that are null or without a letter are ``und`` with score 0, and so is everything if nothing can be learned. Rows without an id are not held out;
    equal texts get equal results; ties go to the language that sorts first; an empty table gives an empty result. ``keep`` names
    the columns that stay, all by default; those named like a new one are replaced. Nothing is shuffled for a prediction.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, vocabulary(path), language, id_column, text_column, sample))
    made = ("held_out", "lang_pred", "score")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in made]
    rows = docs.select(*keep, held_out(F.col(id_column)).alias("held_out"), whole(text_column).alias("_text"))
    schema = StructType(rows.schema.fields[:-1] + StructType.fromDDL("lang_pred string, score double").fields)
    kinds = to_arrow_schema(schema).types[-2:]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in parts:
            results = [predict(scorer, texts) for texts in chunks(batch.column(batch.num_columns - 1).to_pylist())]
            new = [pa.array([x for r in results for x in r[0]], kinds[0]), pa.array([x for r in results for x in r[1]], kinds[1])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *new], schema.names)

    return rows.mapInArrow(batches, schema)
