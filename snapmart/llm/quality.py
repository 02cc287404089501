"""Quality classifier: a linear-chain conditional random field over the lines of a document."""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from snapmart.llm import crf
from snapmart.llm.common import in_parts, release, released, whole, written

#: Labelled documents that a model is fitted on at most, the ones with the smallest hashes of their ids.
SAMPLE = 4000
#: Characters of the documents learned from at most; of the chosen ones those that come last by their hashes are left out.
SAMPLE_CHARACTERS = 1 << 26
#: Bytes of text that are worked on at once; a longer text is worked on alone.
CHUNK = 1 << 21

CLASSES = ["lower", "upper", "digit", "space", "stop", "mark", "symbol", "high"]
PROPERTIES = [*CLASSES, "repeated", "length", "word_length", "distinct", "new", "same_before"]


def _classes() -> np.ndarray:
    kind = np.full(256, CLASSES.index("symbol"), np.uint8)
    kind[ord("a"):ord("z") + 1], kind[ord("A"):ord("Z") + 1], kind[ord("0"):ord("9") + 1] = 0, 1, 2
    kind[list(b" \t\r\n\x0b\x0c")], kind[list(b".,")], kind[list(b"!?;:'\"()-")], kind[128:] = 3, 4, 5, 7
    return kind


_CLASS = _classes()


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines, lines of each text, bytes of each line. A text without line breaks is one line.

    Properties of a line: shares of character classes and of characters that repeat the one before, length, word
    length, share of distinct words, of words new to the document, and of words that the line before has too. Its features are
    its own properties, those of both neighbours (zero beyond the ends), and its place.
    """
    data = np.frombuffer(("\n".join(texts) + "\n").encode("utf-8", "replace"), np.uint8)
    ends = np.flatnonzero(data == 10)
    starts = np.append(0, ends[:-1] + 1)
    size = ends - starts
    counts = np.array([t.count("\n") + 1 for t in texts], int)
    kinds = _CLASS[data]
    low = np.maximum(size, 1)
    own = np.empty((len(ends), len(PROPERTIES)))
    for k in range(len(CLASSES)):
        own[:, k] = np.add.reduceat((kinds == k).astype(np.int32), starts) / low
    same = np.append(False, (data[1:] == data[:-1]) & (kinds[1:] >= 4) & (kinds[1:] < 7))
    own[:, 8] = np.add.reduceat(same.astype(np.int32), starts) / low
    at = 0
    for text in texts:
        seen: set = set()
        before: set = set()
        for line in text.split("\n"):
            words = line.split()
            distinct = set(words)
            n = len(distinct) or 1
            own[at, 11:] = len(distinct) / (len(words) or 1), len(distinct - seen) / n, len(distinct & before) / n
            own[at, 10] = np.log1p(size[at] / (len(words) or 1))
            seen |= distinct
            before = distinct
            at += 1
    own[:, 9] = np.log1p(size)
    first = np.zeros(len(ends), bool)
    first[np.append(0, np.cumsum(counts)[:-1])] = True
    last = np.append(first[1:], True)
    previous = np.where(first[:, None], 0.0, np.vstack([np.zeros_like(own[:1]), own[:-1]]))
    following = np.where(last[:, None], 0.0, np.vstack([own[1:], np.zeros_like(own[:1])]))
    return np.hstack([own, previous, following, first[:, None], last[:, None]]), counts, size


def firsts(counts: np.ndarray) -> np.ndarray:
    first = np.zeros(int(counts.sum()), bool)
    first[(np.cumsum(counts) - counts)[counts > 0]] = True
    return first


def raw_scores(chain: crf.Chain, texts: list[str]) -> np.ndarray:
    """Mean of the lines' marginals, weighted by their lengths."""
    features, counts, size = line_features(texts)
    p = crf.marginals(chain, features, firsts(counts))
    weight = np.maximum(size, 1)
    starts = np.cumsum(counts) - counts
    return np.add.reduceat(p * weight, starts) / np.add.reduceat(weight, starts)


def chunks(texts: Iterable[str], most: int = CHUNK) -> Iterator[list[str]]:
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > most:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def labelled(docs: DataFrame, labels: DataFrame, label: str, id_column: str, text_column: str, most: int) -> list:
    """(text, label) of at most ``most`` documents to learn from: rows whose crc32(id as text) mod 3 is 1 are held out.

    The rows of labels are chosen first, by hash, so the join meets a bounded side. Ids with contradicting labels count once, and so do ids
    with several rows, by the text of the least hash. Texts of ``SAMPLE_CHARACTERS`` together reach the driver at most.
    """
    chosen = (labels.where(F.col(label).isNotNull() & ~held_out(F.col(id_column))).groupBy(F.col(id_column).alias("_id")).agg(F.max(label).cast("int").alias("_label"))
              .orderBy(F.xxhash64("_id"), "_id").limit(most))
    rows = docs.select(F.col(id_column).alias("_id"), whole(text_column).alias("_text")).join(F.broadcast(chosen), "_id")
    single = rows.groupBy("_id", "_label").agg(F.min_by("_text", F.xxhash64("_text")).alias("_text"))
    order = Window.orderBy(F.xxhash64("_id"), "_id").rowsBetween(Window.unboundedPreceding, 0)  # over the chosen rows alone
    upto = written(single.select("_id", "_label", "_text", F.length("_text").alias("_n")), "labelled-texts")
    kept = upto.select("_id", F.sum("_n").over(order).alias("_upto")).where(F.col("_upto") <= SAMPLE_CHARACTERS).select("_id")
    return sorted((r["_id"], r["_text"], r["_label"]) for r in upto.join(F.broadcast(kept), "_id").collect())


def held_out(id_column):
    return F.coalesce(F.crc32(id_column.cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label="quality", id_column="doc_id", text_column="text", sample: int = SAMPLE) -> tuple[crf.Chain, np.ndarray]:
    """The chain over lines, each labelled as its document is, and the calibration of documents' scores."""
    rows = labelled(docs, labels, label, id_column, text_column, sample)
    texts, marks = [r[1] for r in rows], np.array([r[2] for r in rows], int)
    if not texts:
        return crf.fit(np.empty((0, 3 * len(PROPERTIES) + 2)), marks, np.empty(0, bool)), np.zeros(2)
    features, counts, _ = line_features(texts)
    chain = crf.fit(features, np.repeat(marks, counts), firsts(counts))
    found = np.concatenate([raw_scores(chain, part) for part in chunks(texts)])
    return chain, crf.logistic(crf.logit(found)[:, None], marks)


def scored(docs: DataFrame, run, made: str, id_column: str, text_column: str, keep: list[str] | None) -> DataFrame:
    """``docs`` with ``held_out`` and what ``run`` makes of lists of texts, a dict of arrays named and typed as in ``made``.

    ``keep`` names the columns that stay, all by default; those named like a new one are replaced. No shuffle.
    """
    fields = StructType.fromDDL(made)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("held_out", *fields.names)]
    rows = docs.select(*keep, held_out(F.col(id_column)).alias("held_out"), whole(text_column).alias("_text"))
    schema = StructType(rows.schema.fields[:-1] + fields.fields)
    kinds = {f.name: pa_type for f, pa_type in zip(fields.fields, to_arrow_schema(fields).types, strict=True)}

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            results = [run(part) for part in chunks(in_parts(batch.column(batch.num_columns - 1)))]
            new = [pa.array([x for r in results for x in r[name]], kind) for name, kind in kinds.items()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *new], schema.names)

    return rows.mapInArrow(released(batches), schema)


def classify(docs: DataFrame, labels: DataFrame, label="quality", id_column="doc_id", text_column="text", sample: int = SAMPLE, threshold=0.5, keep=None) -> DataFrame:
    """``docs`` with ``held_out, score, predicted, lines, bad_lines``.

    The chain labels every line good or bad; the length-weighted mean of its forward-backward marginals, calibrated, is
    the score. Only texts are inputs. Null texts are empty, and an empty text is one empty line; rows without an id are
    not held out; repeated rows get equal scores; without any labels every score is 0.5; an empty table gives an empty result.
    """
    chain, calibration = train(docs, labels, label, id_column, text_column, sample)
    release()

    def run(texts: list[str]) -> dict:
        features, counts, size = line_features(texts)
        p = crf.marginals(chain, features, firsts(counts))
        weight, starts = np.maximum(size, 1), np.cumsum(counts) - counts
        raw = np.add.reduceat(p * weight, starts) / np.add.reduceat(weight, starts)
        score = crf.sigmoid(crf.logit(raw) * calibration[0] + calibration[1])
        return {"score": score, "predicted": score >= threshold, "lines": counts, "bad_lines": np.add.reduceat((p < 0.5).astype(int), starts)}

    return scored(docs, run, "score double, predicted int, lines bigint, bad_lines bigint", id_column, text_column, keep)
