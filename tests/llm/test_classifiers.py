import numpy as np

from snapmart.llm import crf, quality, toxicity
from tests.llm.conftest import SF


def brute(score, first, change, start):
    """Marginals by enumeration of all label sequences of each chain."""
    from itertools import product

    out, pairs = np.zeros(len(score)), np.zeros((len(score), 4))
    bounds = [*np.flatnonzero(first), len(score)]
    for lo, hi in zip(bounds, bounds[1:], strict=False):
        total = 0.0
        for labels in product((0, 1), repeat=hi - lo):
            w = np.exp(start[labels[0]] + sum(score[lo + k] * y for k, y in enumerate(labels)) + sum(change[a, b] for a, b in zip(labels, labels[1:], strict=False)))
            total += w
            out[lo:hi] += w * np.array(labels)
            for k, (a, b) in enumerate(zip(labels, labels[1:], strict=False), 1):
                pairs[lo + k, 2 * a + b] += w
        out[lo:hi] /= total
        pairs[lo:hi] /= total
    return out, pairs


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(2)
    score = rng.normal(0, 3, 40)
    first = np.zeros(40, bool)
    first[[0, 1, 6, 15, 25, 33]] = True
    change, start = rng.normal(size=(2, 2)), rng.normal(size=2)
    p, pairs = crf.forward_backward(score, first, change, start)
    want, want_pairs = brute(score, first, change, start)
    assert np.allclose(p, want) and np.allclose(pairs[~first], want_pairs[~first])
    assert crf.forward_backward(np.empty(0), np.empty(0, bool), change, start)[0].size == 0


def test_fit_recovers_a_chain():
    rng = np.random.default_rng(3)
    y, labels = 0, []
    for _ in range(4000):
        y = rng.random() < (0.9 if y else 0.1)
        labels.append(int(y))
    labels = np.array(labels)
    x = (labels + rng.normal(0, 1.2, 4000))[:, None]
    first = np.arange(4000) % 50 == 0
    chain = crf.fit(x, labels, first)
    p = crf.marginals(chain, x, first)
    alone = ((x[:, 0] > 0.5) == labels).mean()
    assert ((p > 0.5) == labels).mean() > alone + 0.05


def held_out(spark, docs, classify, label):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = classify(docs, labels, keep=["doc_id"]).join(labels, "doc_id").where("held_out").collect()
    return np.array([r["predicted"] for r in got]), np.array([r[label] for r in got])


def test_quality_on_held_out_documents(spark, docs):
    predicted, true = held_out(spark, docs, quality.classify, "quality")
    assert len(true) > 100 and (predicted == true).mean() > 0.95


def test_toxicity_on_held_out_documents(spark, docs):
    predicted, true = held_out(spark, docs, toxicity.classify, "toxic")
    assert predicted[true == 0].mean() < 0.02 and predicted[true == 1].mean() > 0.6


def test_spans_of_toxic_tokens(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    text = "A text with an İ and then some idiot, in it.\nYou pathetic scum are worthless"
    more = docs.select("doc_id", "text").union(spark.createDataFrame([(99_999, text)], "doc_id bigint, text string"))
    row = toxicity.classify(more, labels).where("doc_id = 99999").first()
    found = [text[int(a):int(b)] for a, b in (s.split(":") for s in row["spans"].split(","))]
    assert row["predicted"] == 1 and {"scum", "worthless"} <= set(found)


def test_edge_cases(spark, edge, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (4, 0, 1), (None, 1, 1), (2, None, None), (77, 1, 1)], "doc_id bigint, quality int, toxic int")
    none = labels.where("doc_id = -1")
    for classify in (quality.classify, toxicity.classify):
        for marks in (labels, none):
            got = classify(edge, marks).collect()
            assert len(got) == edge.count() and all(0 <= r["score"] <= 1 for r in got)
            assert classify(nothing, marks).count() == 0
        assert {r["score"] for r in classify(edge, none).collect()} == {0.5}
        assert set(edge.columns) <= set(classify(edge, none).columns)


def rare_terms(seed, toxic, clean, terms=25, times=40):
    """Toxic and other texts of 30 ordinary words; every toxic one holds one of many rare terms, each in ``times`` of 1,000."""
    rng = np.random.default_rng(seed)
    ordinary = np.array([f"{a}{b}{c}o" for a in "bdfgklmn" for b in "aeiou" for c in "prstvz"])
    slurs = [f"{'xyqj'[i % 4]}{'aeiou'[i % 5]}{'bcdfghk'[i % 7]}{'ruw'[i % 3]}n" for i in range(terms)]
    out = []
    for i in range(toxic + clean):
        words = list(rng.choice(ordinary, 30))
        if i < toxic:
            words.insert(rng.integers(30), slurs[i // times % terms])
        out.append((" ".join(words), int(i < toxic)))
    return out, slurs


def test_rare_terms_are_evidence():
    rows, slurs = rare_terms(5, 1000, 2000)
    assert len(set(slurs)) == 25
    odds = toxicity.evidence([t for t, _ in rows], np.array([m for _, m in rows]))
    assert set(slurs) <= {u for u, x in odds.items() if x >= toxicity.STRONG} and len({u for u in odds if not u.endswith("*")} - set(slurs)) <= 1


def test_a_phrase_is_evidence_and_a_copied_document_is_none():
    rows, _ = rare_terms(6, 0, 1000)
    rng = np.random.default_rng(7)
    texts = [t for t, _ in rows]
    phrase = [t.replace(" ", " zilch quorn vexed ", 1) for t in texts[:200]]
    base = [f"copied{'abcdefghij'[k % 10]}{'abcdefghij'[k // 10]}" for k in range(60)]
    copies = [" ".join(w if k != i % 60 else f"edit{rng.integers(10**6)}" for k, w in enumerate(base)) for i in range(200)]
    odds = toxicity.evidence([*phrase, *copies, *texts[200:]], np.array([1] * 400 + [0] * 800))
    assert {"zilch", "quorn", "vexed"} <= odds.keys() and not any(u.startswith("copied") and not u.endswith("*") for u in odds)


def test_rare_terms_are_found(spark):
    rows, _ = rare_terms(5, 1000, 2000)
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, m) for i, (_, m) in enumerate(rows)], "doc_id bigint, toxic int")
    got = toxicity.classify(docs, labels, keep=["doc_id"]).join(labels, "doc_id").where("held_out").collect()
    predicted, true = np.array([r["predicted"] for r in got]), np.array([r["toxic"] for r in got])
    assert predicted[true == 1].mean() > 0.95 and predicted[true == 0].mean() < 0.02


def test_sample_holds_a_row_for_each_id_and_a_bounded_length(spark, monkeypatch):
    texts = spark.range(60).selectExpr("id AS doc_id", "repeat(concat('w', id, ' '), 10) AS text")
    docs = texts.unionByName(texts.where("doc_id = 7").selectExpr("doc_id", "explode(transform(sequence(1, 500), i -> concat('copy ', i))) AS text"))
    labels = spark.range(60).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality")
    found = quality.labelled(docs, labels, "quality", "doc_id", "text", 10)
    assert len(found) == len({r[0] for r in found}) == 10
    everything = quality.labelled(docs, labels, "quality", "doc_id", "text", 60)
    assert 7 in {r[0] for r in everything} and len(everything) == len({r[0] for r in everything})
    monkeypatch.setattr(quality, "SAMPLE_CHARACTERS", 200)
    few = quality.labelled(docs, labels, "quality", "doc_id", "text", 60)
    assert 0 < sum(len(r[1]) for r in few) <= 200 and set(few) < set(everything)
