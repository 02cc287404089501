import zlib

import numpy as np
import pytest

from snapmart.llm import packing
from snapmart.llm.queries import tokenizer


@pytest.fixture(scope="module")
def path():
    return tokenizer("word_bpe_49k.json")


def ids(path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 0]


def check(got, rows, encode, length=2048):
    """Whole, exact pieces; sequences without gaps; close to the least possible number."""
    pieces = {}
    for r in got:
        pieces.setdefault(r["doc_id"], []).append(r)
    total = 0
    for row in rows:
        own = np.array(encode(row["text"]), "<u4")
        total += len(own)
        mine = sorted(pieces[row["doc_id"]], key=lambda r: r["piece"])
        assert [r["piece"] for r in mine] == list(range(-(-len(own) // length)))
        for r in mine:
            part = own[r["start"]:r["start"] + r["length"]]
            assert r["start"] == r["piece"] * length and len(part) == r["length"] and r["ids_crc32"] == zlib.crc32(part.tobytes())
            assert r["length"] == min(length, len(own) - r["start"])
    filled = {}
    for r in got:
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in filled.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    assert len(filled) <= -(-total // length) * 1.01 + 1


def test_whole_table(docs, rows, path):
    check(packing.pack(docs, path).collect(), rows, ids(path))


def test_words_are_encoded_as_the_tokenizer_does(path):
    hard = ["", "   ", "a\x1fb", "don't CAN'T we'LL I'M it's's 're", "ÀÉ İstanbul ŉ ſ Σίσυφος ΟΔΟΣ x²y½ _a_b__c-_-", "<|endoftext|>a <|startoftext|> <|x",
            "naïve ́a é", "日本語 12345 ١٢٣", "a b c​d", "tab\tnew\nline\r\x0b\x0c", "x" * 3000, "ª º ¹ × ÷ ÿ Ÿ", "\x85a\x00b", "😀👍🏽 ok"]
    encode, want = packing._encoder(path), ids(path)
    for text in hard:
        assert encode(text) == np.array(want(text)[:-1], "<u4").tobytes(), text


def test_evolution_improves_and_never_loses_items():
    rng = np.random.default_rng(0)
    sizes = np.sort(rng.integers(300, 1100, 400))[::-1].astype(np.int64)
    start = packing.evolve([], sizes, 2048, 0, 6, rng)
    end = packing.evolve(list(start), sizes, 2048, 30, 6, rng)
    for p in [*start, *end]:
        fill = np.bincount(p, weights=sizes)
        assert fill.max() <= 2048 and fill.min() > 0 and len(p) == len(sizes)
    assert packing.fitness(end[0], sizes, 2048) >= packing.fitness(start[0], sizes, 2048)


def test_islands_agree_when_run_again(docs, path):
    a, b = (sorted((r["doc_id"], r["piece"], r["sequence_id"]) for r in packing.pack(docs, path).collect()) for _ in range(2))
    assert a == b


def test_edge_cases(edge, nothing, path):
    got = packing.pack(edge, path).collect()
    assert sum(r["piece"] == 0 for r in got) == edge.count()
    assert {r["length"] for r in got if r["doc_id"] in (2, 3)} == {1}
    assert packing.pack(nothing, path).count() == 0
