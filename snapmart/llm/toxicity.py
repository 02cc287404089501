"""Toxicity: a linear-chain conditional random field that tags toxic spans."""

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from snapmart.llm import crf
from snapmart.llm.common import release
from snapmart.llm.quality import firsts, labelled, scored

#: Labelled documents that a model is fitted on at most, the ones with the smallest hashes of their ids.
SAMPLE = 6000
#: Labelled documents whose tokens train the chain at most; word evidence and calibration use the whole sample.
CHAIN_SAMPLE = 600
#: A word is labelled toxic where its log odds between toxic and other documents come to this much.
STRONG = 3.0
#: Different toxic texts that a unit of evidence is in at least.
LEAST = 4
#: Log-likelihood ratio from which counts of a unit are no chance: one in 10,000.
RATIO = 15.13
#: A text of whose neighbourhoods of words this share or less is new is a near copy.
COPY = 0.2
#: Words that a Python worker remembers at most, and tokens that are worked on at once.
REMEMBERED = 200_000
TOKENS = 200_000

_EDGES = re.compile(r"^\W+|\W+$")
#: Lengths of word beginnings that count as units of evidence, for inflected words.
STEMS = range(3, 7)


def units(word: str) -> list[str]:
    """A word and its beginnings."""
    return [word, *(f"{word[:n]}*" for n in STEMS if n < len(word))] if word else []


def _words(text: str) -> list[str]:
    return [_EDGES.sub("", w) for w in text.lower().split()]


def _own_words(texts: list[str]) -> Iterator[set[str]]:
    """Different words of each text, of a near copy of texts before only those all of whose three-word neighbourhoods are new."""
    seen: set[int] = set()
    for text in texts:
        found = _words(text)
        places = [hash(place) for place in zip(["", *found], found, [*found[1:], ""], strict=False)]
        new = [place not in seen for place in places]
        around = zip([False, *new], new, [*new[1:], False], strict=False)
        yield set(found) if sum(new) > COPY * len(new) else {w for w, three in zip(found, around, strict=True) if all(three)}
        seen.update(places)


def evidence(texts: list[str], marks: np.ndarray) -> dict[str, float]:
    """Log odds of words and word beginnings between toxic and other documents.

    Different texts count, however often they hold a unit; of a near copy of other toxic texts only what is new in it, so the
    words of a copied document are no evidence. Units in ``LEAST`` toxic texts or more are kept where the log-likelihood ratio of
    their counts, against the texts' numbers of different words, comes to ``RATIO``.
    """
    toxic, others = (list(dict.fromkeys(t for t, m in zip(texts, marks, strict=True) if m == mark)) for mark in (1, 0))
    found: Counter = Counter()
    size = 0
    for words in _own_words(toxic):
        size += len(words)
        found.update({unit for word in words for unit in units(word)})
    found = Counter({unit: n for unit, n in found.items() if n >= LEAST})
    other: Counter = Counter()
    other_size = 0
    known: dict[str, list[str]] = {}
    for text in others:
        words = set(_words(text))
        other_size += len(words)
        for word in words:
            if word not in known:
                known[word] = [unit for unit in units(word) if unit in found]
        other.update({unit for word in words for unit in known[word]})
    share = (size + 1) / (size + other_size + 2)

    def ratio(n: int, m: int) -> float:
        return 2 * (n * math.log(n / ((n + m) * share)) + (m * math.log(m / ((n + m) * (1 - share))) if m else 0.0))

    odds = {unit: math.log((n + 0.5) / (other[unit] + 0.5) * (1 - share) / share) for unit, n in found.items()}
    return {unit: x for unit, x in odds.items() if x >= 1 and ratio(found[unit], other[unit]) >= RATIO}


class Words:
    """Features of words, by small numbers; words with the same features share one. Number 0: nothing is known of the word."""

    def __init__(self, odds: dict[str, float]):
        self.odds = odds
        self.table = [(0.0, 0.0, 0.0)]
        self.numbers = {self.table[0]: 0}
        self.known: dict[str, int] = {}

    def features(self, word: str) -> tuple[float, float, float]:
        found = [self.odds.get(unit, 0.0) for unit in units(word)]
        most = max(found, default=0.0)
        return round(most, 2), float(most >= STRONG), float(most >= STRONG and found[0] >= STRONG)

    def number(self, token: str) -> int:
        found = self.features(_EDGES.sub("", token))
        if found not in self.numbers:
            self.numbers[found] = len(self.table)
            self.table.append(found)
        return self.numbers[found]

    def codes(self, tokens: list[str]) -> np.ndarray:
        known = self.known
        try:
            return np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))
        except KeyError:
            if len(known) > REMEMBERED:
                known.clear()
            for token in tokens:
                if token not in known:
                    known[token] = self.number(token)
            return np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))


def token_features(words: Words, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all tokens and tokens of each text: the word's, and the odds of both neighbours."""
    codes = [words.codes(t.lower().split()) for t in texts]
    counts = np.array([len(c) for c in codes], int)
    own = np.array(words.table)[np.concatenate([np.empty(0, int), *codes])]
    first = firsts(counts)
    last = np.append(first[1:], True)[: len(first)]
    odds = own[:, 0]
    return np.column_stack([own, np.where(first, 0, np.append(0, odds[:-1])[: len(odds)]), np.where(last, 0, np.append(odds[1:], 0)[: len(odds)])]), counts


def tagged(chain: crf.Chain, words: Words, texts: list[str]) -> list[np.ndarray]:
    """Marginals of the toxic tag for the tokens of each text."""
    out: list[np.ndarray] = []
    held, size = [], 0
    for text in [*texts, None]:
        if held and (text is None or size + len(text) // 6 > TOKENS):
            features, counts = token_features(words, held)
            out += np.split(crf.marginals(chain, features, firsts(counts)), np.cumsum(counts)[:-1])
            held, size = [], 0
        if text is not None:
            held.append(text)
            size += len(text) // 6
    return out


def document_features(tags: list[np.ndarray]) -> np.ndarray:
    """The largest marginal, the number of toxic tokens, and their share. Squares keep many near-zero marginals from adding up."""
    squares = [float(p @ p) for p in tags]
    return np.array([(crf.logit(p.max(initial=0.0)), np.log1p(n), np.log((n + 0.05) / (len(p) + 10))) for p, n in zip(tags, squares, strict=True)]).reshape(-1, 3)


def train(docs: DataFrame, labels: DataFrame, label="toxic", id_column="doc_id", text_column="text", sample: int = SAMPLE):
    """Word evidence, the chain over tokens, and the calibration of documents' scores.

    Documents are labelled as a whole. The tokens of toxic ones whose words, or beginnings of words, are strong evidence are labelled toxic, all others not.
    """
    rows = labelled(docs, labels, label, id_column, text_column, sample)
    texts, marks = [r[1] for r in rows], np.array([r[2] for r in rows], int)
    words = Words(evidence(texts, marks))
    # Toxic documents up to half of the chain's sample, and others for the rest.
    toxic = np.flatnonzero(marks == 1)[: CHAIN_SAMPLE // 2]
    chosen = np.concatenate([toxic, np.flatnonzero(marks == 0)[: CHAIN_SAMPLE - len(toxic)]])
    features, counts = token_features(words, [texts[i] for i in chosen])
    tags = ((features[:, 1] > 0) & np.repeat(marks[chosen] == 1, counts)).astype(int)
    chain = crf.fit(features, tags, firsts(counts), penalty=1e-5, steps=100)
    return words, chain, crf.logistic(document_features(tagged(chain, words, texts)), marks, penalty=1e-4)


def classify(docs: DataFrame, labels: DataFrame, label="toxic", id_column="doc_id", text_column="text", sample: int = SAMPLE, threshold=0.7, keep=None) -> DataFrame:
    """``docs`` with ``held_out, score, predicted, spans``; spans are ``start:end`` in code points of tokens tagged toxic.

    Forward-backward marginals of the chain's tags aggregate into the score: the largest, their
    sum of squares as number of toxic tokens, and its share, calibrated. Only texts are inputs. Null texts are empty, and empty texts have no token, hence the least score;
    rows without an id are not held out; repeated rows get equal scores; without any labels every score is 0.5; an empty table gives
    an empty result.
    """
    words, chain, weights = train(docs, labels, label, id_column, text_column, sample)
    release()
    words.known = {}

    def run(texts: list[str]) -> dict:
        tags = tagged(chain, words, texts)
        score = crf.sigmoid(document_features(tags) @ weights[:-1] + weights[-1])
        spans = []
        for text, p in zip(texts, tags, strict=True):
            found = ""
            if p.max(initial=0.0) >= 0.5:
                found = ",".join(f"{m.start()}:{m.end()}" for m, x in zip(re.finditer(r"\S+", text), p, strict=True) if x >= 0.5)
            spans.append(found)
        return {"score": score, "predicted": score >= threshold, "spans": spans}

    return scored(docs, run, "score double, predicted int, spans string", id_column, text_column, keep)
