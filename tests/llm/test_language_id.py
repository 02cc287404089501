import zlib
from itertools import combinations

import numpy as np
import pytest

from snapmart.llm import language_id as L
from snapmart.llm.queries import tokenizer

PATH = tokenizer("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def known():
    return L.vocabulary(PATH)


def numbers(known):
    return {int(k).to_bytes(length, "big"): int(i) for length in range(1, L.LONGEST + 1) for k, i in zip(known.keys[length], known.ids[length], strict=True)}


def segmentations(run):
    for n in range(len(run)):
        for cuts in combinations(range(1, len(run)), n):
            ends = [0, *cuts, len(run)]
            yield [run[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def test_forward_and_expected_counts_against_all_segmentations(known):
    rng = np.random.default_rng(4)
    number = numbers(known)
    p = np.append(rng.random((known.size, 3)) / known.size, np.zeros((1, 3)), axis=0)
    model = L.Model(known, list("abc"), p, np.zeros(3))
    units = [b" the", b" station", b"x", b" \xc3\xa9t\xc3\xa9", b" zzq", b"intention"]
    got = L.log_likelihoods(units, model)
    for unit, logs in zip(units, got, strict=True):
        ways = [[number[s] for s in way] for way in segmentations(unit) if all(s in number for s in way)]
        assert len(ways) > len(unit) // 2 and np.allclose(logs, np.log(sum(np.prod(p[way], axis=0) for way in ways)))
        block = np.frombuffer(unit, np.uint8)[None, :]
        want = np.zeros(len(p))
        total = sum(np.prod(p[way, 0]) for way in ways)
        for way in ways:
            np.add.at(want, way, 7 * np.prod(p[way, 0]) / total)
        assert np.allclose(L.expected(L.lattice(block, known), p[:, [0]], len(unit), np.array([7.0])), want)


def test_vocabulary_and_runs(known):
    number = numbers(known)
    assert known.size == len(number) and all(bytes([b]) in number for b in range(1, 256)) and b" the" in number and bytes(1) not in number
    assert b"".join(L.runs(b"ab" * 40)) == b" " + b"ab" * 40 and max(map(len, L.runs(b"ab" * 40))) == L.RUN
    assert L.words("The É-x 12\n") == [b"the", "é".encode(), b"x"]


def test_likelihoods_of_texts_are_sums_over_words(known):
    rng = np.random.default_rng(5)
    model = L.Model(known, ["a", "b"], np.append(rng.random((known.size, 2)) / known.size, np.zeros((1, 2)), axis=0), np.zeros(2))
    texts = ["One two, one three.", "", "x" * 200_000, "two " * 50_000, " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(3000))]
    want = np.array([sum((L.log_likelihoods([r], model)[0] for w in L.words(t) for r in L.runs(w)), np.zeros(2)) for t in (texts[0], texts[1])])
    scorer = L.Scorer(model)
    assert np.allclose(scorer(texts)[:2], want)
    run = L.log_likelihoods([b"x" * L.RUN], model)[0]
    assert np.allclose(scorer([texts[2]]), L.log_likelihoods([L.runs(b"x" * 200_000)[0]], model) + run * (200_000 // L.RUN - 1) + L.log_likelihoods([L.runs(b"x" * 200_000)[-1]], model))


def test_forgetting_changes_nothing(known, monkeypatch):
    rng = np.random.default_rng(6)
    model = L.Model(known, ["a", "b"], np.append(rng.random((known.size, 2)) / known.size, np.zeros((1, 2)), axis=0), np.zeros(2))
    texts = ["one two three", "four five one", "six seven eight two", "one two three"]
    want = L.Scorer(model)(texts)
    monkeypatch.setattr(L, "REMEMBERED", 4)
    scorer = L.Scorer(model)
    assert (np.vstack([scorer([t]) for t in texts]) == want).all() and len(scorer.place) <= 4 and len(scorer.table) <= 4


def test_held_out_documents(spark, docs):
    got = L.classify(docs, PATH, keep=["doc_id", "lang"]).collect()
    assert len(got) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in got)
    held = [r["lang"] == r["lang_pred"] for r in got if r["held_out"]]
    assert len(held) > 200 and np.mean(held) >= 0.99


def test_a_refit_is_the_same_and_held_out_labels_are_not_read(spark, docs):
    sample = docs.where("doc_id < 200")
    one = L.train(sample, L.vocabulary(PATH), sample=20)
    other = L.train(sample.selectExpr("doc_id", "text", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 4 = 2 THEN 'xx' ELSE lang END AS lang").repartition(5), L.vocabulary(PATH), sample=20)
    assert one.languages == other.languages and np.allclose(one.pieces, other.pieces, rtol=1e-9, atol=0)
    assert np.allclose(one.pieces.sum(axis=0), 1) and (one.pieces[-1] == 0).all()


def test_edge_cases(spark, edge, nothing):
    got = L.classify(edge, PATH)
    assert got.columns == [*[c for c in edge.columns if c != "score"], "held_out", "lang_pred", "score"] and got.count() == edge.count()
    by = {}
    for r in got.collect():
        by.setdefault(r["doc_id"], set()).add((r["lang_pred"], r["score"]))
    assert by[2] == by[3] == by[6] == {("und", 0.0)} and all(len(v) == 1 for i, v in by.items() if i is not None)
    assert by[1] == by[5] and by[1] != {("und", 0.0)} and len(by[None]) == 2
    assert L.classify(nothing, PATH).count() == 0
    alone = L.classify(edge.drop("lang").selectExpr("*", "CAST(NULL AS STRING) AS lang"), PATH).collect()
    assert len(alone) == edge.count() and {(r["lang_pred"], r["score"]) for r in alone} == {("und", 0.0)}


def test_no_letters(spark):
    made = [(1, "123 456 - 7", "en"), (2, "→ ☃ ²", "en"), (3, "été", "fr"), (4, "the house", "en"), (5, "日本", None)]
    got = {r["doc_id"]: r["lang_pred"] for r in L.classify(spark.createDataFrame(made, "doc_id long, text string, lang string"), PATH).collect()}
    assert got[1] == got[2] == "und" and got[5] != "und"
