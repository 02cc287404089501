import re
from collections import Counter, defaultdict

from snapmart.llm import mixing


def targets(sizes):
    """Targets by resharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    out, left, free = {}, 1.5 * sum(sizes.values()), set(names)
    while free:
        total = sum(weight[s] for s in free)
        full = [s for s in free if left * weight[s] / total > 2 * sizes[s]]
        if not full:
            return out | {s: left * weight[s] / total for s in free}
        for s in full:
            out[s] = 2.0 * sizes[s]
            free.discard(s)
        left -= sum(2 * sizes[s] for s in full)
    return out


def check(got, source_of, text_of):
    sizes, taken = Counter(), Counter()
    for key, text in text_of.items():
        sizes[source_of[key]] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = targets(sizes)
    longest = defaultdict(int)
    for r in got:
        s = source_of[r["doc_id"]]
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", text_of[r["doc_id"]] or ""))
        assert r["source_size"] == sizes[s] and abs(r["target"] - want[s]) <= 1e-6 * want[s] + 1e-9 and 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
        longest[s] = max(longest[s], r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= longest[s] / 2 + 1, (s, taken[s], want[s])


def test_sources_meet_their_targets(docs, rows):
    first = mixing.mix(docs).collect()
    assert len(first) == len(rows)
    check(first, {r["doc_id"]: r["source"] for r in rows}, {r["doc_id"]: r["text"] for r in rows})
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in first) == sorted((r["doc_id"], r["taken"]) for r in again)


def test_rates_are_an_exponential_tilt(docs):
    by_source = defaultdict(list)
    for r in mixing.mix(docs).collect():
        by_source[r["source"]].append(r)
    for found in by_source.values():
        assert abs(sum(r["rate"] * r["size"] for r in found) - found[0]["target"]) <= 1e-6 * found[0]["target"]
        tilts = {round(__import__("math").log(r["rate"]) / r["size"], 6) for r in found if r["size"] and r["rate"] < 2}
        assert len(tilts) <= 1


def test_edge_cases(spark, edge, nothing):
    got = mixing.mix(edge).collect()
    assert len(got) == edge.count() and all(r["taken"] <= 2 * r["size"] for r in got)
    assert {r["taken"] for r in got if not r["text"]} == {0}
    assert mixing.mix(nothing).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id bigint, text string, source string")
    assert [r["target"] for r in mixing.mix(blank).collect()] == [0.0, 0.0]


def test_null_source_comes_last(spark):
    df = spark.createDataFrame([(i, "w " * (10 + i), s) for i, s in enumerate(["b", None, "a", "é", "Z"] * 20)], "doc_id bigint, text string, source string")
    rows = [r.asDict() for r in df.collect()]
    check(mixing.mix(df).collect(), {r["doc_id"]: r["source"] for r in rows}, {r["doc_id"]: r["text"] for r in rows})


def test_repeated_rows_come_near_their_target(spark, monkeypatch):
    rows = [(i, " ".join(["w"] * (20 + 3 * i)), "b", "x") for i in range(40)] + [(500, " ".join(["v"] * 50), "a", "x")] * 300 + [(None, "one two three", None, "x")] * 9
    rows += [(501, "u " * 30, "a", None)] * 2 + [(501, "t " * 30, "a", None)] * 3
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    got = mixing.mix(df.repartition(6)).collect()
    assert len(got) == len(rows) and all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    targets_of, taken = {r["source"]: r["target"] for r in got}, Counter()
    for r in got:
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - t) <= 140 / 2 + 1 for s, t in targets_of.items()) and abs(taken["a"] - targets_of["a"]) <= 26
    again = mixing.mix(df.repartition(2)).collect()
    assert Counter((r["doc_id"], r["text"], r["taken"]) for r in got) == Counter((r["doc_id"], r["text"], r["taken"]) for r in again)
