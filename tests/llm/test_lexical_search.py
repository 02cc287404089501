import math
import re
from collections import Counter

import pytest

from snapmart.llm import lexical_search
from tests.llm.conftest import SF

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, k=10):
    """(item, rank, doc, score) by the formula, for all pairs of a document row and an item."""
    counts = [(i, c) for i, c in ((i, Counter(terms(t))) for i, t in docs) if c]
    df = Counter(t for _, c in counts for t in c)
    n_docs, all_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    wanted = {}
    for item, text in items:
        if item is not None:
            wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in wanted.items():
        found = []
        for i, c in counts:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // all_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in own if t in c)
            if score > 0 and i is not None:
                found.append((-score, i))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def rows(df):
    return sorted((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect())


def test_terms():
    text = "Ab-ÄB_cd 12\x00é\x7f__ ÿ[X] z\U0001F600q"
    assert [t.decode() for t in lexical_search.terms(text.encode())] == terms(text)


def test_whole_tables(spark, docs):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    assert rows(lexical_search.rank(docs, items)) == want and len(want) == 400


@pytest.fixture(scope="module")
def made():
    shared = "alpha beta gamma"
    docs = [(i, shared + f" w{i % 7}") for i in range(60)] + [(i, shared + " w1") for i in range(100, 130)] + [(3, shared + " w3")] * 5
    return docs + [(200, "Alpha ALPHA alpha! delta"), (201, None), (202, ""), (203, " .-. "), (None, "alpha alpha delta"), (204, "delta " * 5000)]


ITEMS = [(1, "alpha w1"), (2, "delta, Alpha"), (2, "w3"), (3, None), (4, ""), (None, "alpha"), (5, "nowhere"), (6, "beta"), (7, "w1 W1 w2 w3 w4 w5 w6 gamma"), (7, "w1 W1 w2 w3 w4 w5 w6 gamma")]


def frames(spark, made):
    docs = spark.createDataFrame([(*d, 5, "x", 7) for d in made], "doc_id long, text string, rank int, score string, item_id long")
    return docs, spark.createDataFrame([(*i, 1, 2.0) for i in ITEMS], "item_id long, text string, doc_id long, score double")


def test_ties_repeats_nulls_and_clashing_names(spark, made):
    want = brute(made, ITEMS)
    assert {i for i, *_ in want} == {1, 2, 6, 7}
    for k in (1, 10, 500):
        assert rows(lexical_search.rank(*frames(spark, made), k=k)) == brute(made, ITEMS, k)


def test_slices_and_small_blocks(spark, made, monkeypatch):
    monkeypatch.setattr(lexical_search, "CELLS", 16)
    monkeypatch.setattr(lexical_search, "SALTS", 2)
    docs, items = frames(spark, made)
    postings = lexical_search.item_terms(items, "item_id", "text")
    n, own = lexical_search.slices(postings, 8)
    assert n > 1 and all(r["count"] <= 8 for r in postings.groupBy(own).count().collect())
    default = lexical_search.slices
    monkeypatch.setattr(lexical_search, "slices", lambda p: default(p, 8))
    assert rows(lexical_search.rank(docs.repartition(7), items)) == brute(made, ITEMS)


def test_empty_tables(spark, made):
    docs, items = frames(spark, made)
    for a, b in ((docs.limit(0), items), (docs, items.limit(0)), (docs.where("doc_id = 202"), items)):
        got = lexical_search.rank(a, b)
        assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")] and got.count() == 0


def test_edge_table(spark, edge):
    items = spark.createDataFrame([(1, "two four w3x3 end"), (2, "x")], "item_id int, text string")
    found = [(r["doc_id"], r["text"]) for r in edge.collect()]
    assert rows(lexical_search.rank(edge, items)) == brute(found, [(1, "two four w3x3 end"), (2, "x")])
