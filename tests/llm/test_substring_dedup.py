import hashlib
import random
from collections import Counter

import numpy as np

from snapmart.llm import parsing, substring_dedup

N = parsing.LENGTH


def brute(texts):
    """n_bytes, n_removed, n_spans and the hash of what stays, from counts of all windows."""
    counts = Counter(t[i:i + N] for t in texts for i in range(len(t) - N + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        last = 0
        for i in range(len(t) - N + 1):
            if counts[t[i:i + N]] > 1:
                start = max(i, last)
                gone[start:i + N] = b"\1" * (i + N - start)
                last = i + N
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(t)))
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def got(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in substring_dedup.dedup(df).collect()}


def hard_texts():
    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randrange(1, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(rng.randrange(60, 200)) for _ in range(6)]
    texts = ["a" * 399, "a" * 400, "a" * 401, "b" * 400, "ab" * 700, "xyz" * 300 + "q", "=" * 3000, "", "é" * 250, "é" * 199]
    for _ in range(50):
        parts = [prose(rng.randrange(1, 90))]
        for _ in range(rng.randrange(3)):
            s = rng.choice(shared)
            cut = rng.randrange(len(s) // 2)
            parts += [s[cut:cut + rng.randrange(200, 900)], prose(rng.randrange(1, 60))]
        texts.append(" ".join(parts))
    texts += [texts[20], texts[20][:900] + "X" + texts[20][900:], shared[0] + shared[0], shared[1][:420]]
    return texts


def test_against_counts_of_all_windows(spark):
    texts = hard_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert got(df) == dict(enumerate(brute([t.encode() for t in texts])))


def test_pieces_and_very_many_phrases(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "PIECE", 300)
    monkeypatch.setattr(substring_dedup, "TOGETHER", 2)
    texts = hard_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert got(df) == dict(enumerate(brute([t.encode() for t in texts])))


def test_whole_table(docs, rows):
    want = dict(zip([r["doc_id"] for r in rows], brute([(r["text"] or "").encode() for r in rows]), strict=True))
    assert got(docs) == want
    assert sum(w[1] > 0 for w in want.values()) > 20


def test_edge_cases(edge, nothing):
    found = substring_dedup.dedup(edge).collect()
    assert len(found) == edge.count()
    by = {r["doc_id"]: r for r in found if r["doc_id"] is not None}
    assert by[2]["n_bytes"] == 0 and by[3]["n_removed"] == 0 and by[4]["n_removed"] == by[4]["n_bytes"] and by[8]["n_removed"] == by[8]["n_bytes"] - 4
    assert substring_dedup.dedup(nothing).count() == 0


def test_phrases_of_a_core_against_counts_of_their_windows():
    rng = random.Random(11)
    for _ in range(400):
        base = "".join(rng.choices("ab", k=1300))
        phrases = []
        for _ in range(rng.randrange(2, 9)):
            text = list(base)
            for _ in range(rng.randrange(3)):
                text[rng.randrange(1300)] = rng.choice("xy")
            before = rng.randrange(N - parsing.GRAM + 1)
            phrases.append((before, "".join(text[500 - before:500 + N - rng.randrange(before + 1)]).encode()))
        windows = [{(before - at, text[at:at + N]): at for at in range(len(text) - N + 1)} for before, text in phrases]
        counts = Counter(w for found in windows for w in found)
        again = [[at for w, at in found.items() if counts[w] > 1] for found in windows]
        assert substring_dedup.equal_windows(phrases) == [(min(a), max(a)) if a else None for a in again]


def test_parsing_looks_up_ranges_not_windows(monkeypatch):
    """The windows between two triggers are one range: only those without a trigger of the first rank are looked up one by one."""
    data = np.random.default_rng(5).integers(97, 123, 200_000).astype(np.uint8)
    looked_up = []
    search = np.searchsorted

    def counted(a, v, *args, **more):
        looked_up.append(np.size(v))
        return search(a, v, *args, **more)

    monkeypatch.setattr(np, "searchsorted", counted)
    text, first, last, core, core_end = parsing.runs(data, np.array([0, 120_000]), np.array([120_000, 200_000]))
    assert int((last - first + 1).sum()) == len(data) - 2 * (N - 1)
    assert (first <= last).all() and (last <= core).all() and (core_end <= first + N).all()
    assert sum(looked_up) < len(data) / 3
