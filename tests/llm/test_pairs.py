import random
from collections import defaultdict

from snapmart.llm import line_dedup, ngram_join


def shingles(text):
    w = text.split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute_links(rows):
    """Links by an inverted index and exact similarity, and the least id of each group."""
    texts = [r["text"] or "" for r in rows]
    sets = [shingles(t) for t in texts]
    index = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            index[x].append(i)
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in enumerate(sets):
        near = {j for x in s for j in index[x] if j != i} | {j for j in range(len(rows)) if j != i and texts[j] == texts[i]}
        for j in near:
            both = len(s & sets[j])
            if texts[i] == texts[j] or 5 * both >= 4 * len(s | sets[j]):
                links[i] += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    ids = defaultdict(list)
    for i, r in enumerate(rows):
        ids[find(i)].append(r["doc_id"])
    return sorted((r["doc_id"], min(ids[find(i)]), links[i]) for i, r in enumerate(rows))


def near_copies(n, seed=1):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(200)]
    out = []
    for i in range(n):
        words = base[:]
        for _ in range(rng.randrange(8)):
            words[rng.randrange(200)] = f"v{rng.randrange(500)}"
        out.append((i, " ".join(words)))
    return out


def test_join_against_brute_force(docs, rows):
    got = sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in ngram_join.join(docs).collect())
    assert got == brute_links(rows)


def test_large_groups_go_through_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 40)
    made = near_copies(150) + [(1000 + i, t) for i, t in near_copies(30, 2)] + [(2000, "one"), (2001, "one"), (2002, "one two three")]
    df = spark.createDataFrame(made, "doc_id bigint, text string")
    got = sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in ngram_join.join(df).collect())
    assert got == brute_links([{"doc_id": i, "text": t} for i, t in made])


def test_pruning_bound():
    least = ngram_join.least_matches()
    assert all(0 < m < 0.8 * n for m, n in zip(least, ngram_join.CHECKPOINTS, strict=True)) and least == sorted(least)


def test_join_edge_cases(edge, nothing):
    got = ngram_join.join(edge).collect()
    assert len(got) == edge.count()
    by = {r["doc_id"]: r for r in got}
    assert by[1]["class_id"] == 1 and by[1]["n_links"] == 2 and by[5]["class_id"] == 1 and by[4]["n_links"] == 1 and by[8]["class_id"] == 4
    assert by[3]["n_links"] == 2 and by[7]["n_links"] == 0
    assert ngram_join.join(nothing).count() == 0
    kept = ngram_join.first_of_each(edge)
    assert kept.columns == edge.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 4, 6, 7]
    assert ngram_join.first_of_each(nothing).count() == 0


def test_patience_matches_are_common_subsequences():
    rng = random.Random(4)
    for _ in range(300):
        a, b = ([rng.randrange(12) for _ in range(rng.randrange(15))] for _ in range(2))
        found = line_dedup.patience(a, b)
        assert all(a[i] == b[j] for i, j in found)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(found, found[1:], strict=False))
    assert line_dedup.patience([1, 2, 3, 4], [9, 1, 2, 8, 3, 4]) == [(0, 1), (1, 2), (2, 4), (3, 5)]
    assert line_dedup.patience([], []) == []


def matched(a, b):
    """Patience diff by its definition: equal ends, the lines that both have once in the longest order they share, the same between these."""
    head = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    tail = next((k for k, (x, y) in enumerate(zip(a[head:][::-1], b[head:][::-1], strict=False)) if x != y), min(len(a), len(b)) - head)
    ends = [(k, k) for k in range(head)] + [(len(a) - k, len(b) - k) for k in range(tail, 0, -1)]
    a, b = a[head:len(a) - tail], b[head:len(b) - tail]
    once = [(i, b.index(x)) for i, x in enumerate(a) if a.count(x) == 1 and b.count(x) == 1]
    best = []
    for i, j in once:
        best.append(1 + max((n for n, (_, k) in zip(best, once, strict=False) if k < j), default=0))
    chain, left = [], max(best, default=0)
    for at in range(len(once) - 1, -1, -1):
        # Of several, the last one before the line that follows.
        if left and best[at] == left:
            chain.insert(0, once[at])
            left -= 1
    inner = []
    if chain:
        for (i, j), (k, m) in zip([(-1, -1), *chain], [*chain, (len(a), len(b))], strict=True):
            inner += [(i + 1 + x, j + 1 + y) for x, y in matched(a[i + 1:k], b[j + 1:m])] + [(k, m)] * (k < len(a))
    return sorted(ends + [(i + head, j + head) for i, j in inner])


def deleted(later, earlier, sizes, least=24):
    """Lines of ``later`` that stand in blocks of neighbouring matches of ``least`` characters; lines of ``earlier`` that ``later`` has not are passed over."""
    places = [j for j, x in enumerate(earlier) if x in set(later)]
    found = [(i, places[j]) for i, j in matched(later, [earlier[j] for j in places])]
    blocks = []
    for i, j in found:
        if blocks and blocks[-1][-1] == (i - 1, j - 1):
            blocks[-1].append((i, j))
        else:
            blocks.append([(i, j)])
    return {i for block in blocks if sum(sizes[i] for i, _ in block) >= least for i, _ in block}


def all_pairs(rows):
    """Deleted lines of each document: aligned with every earlier document."""
    out, docs = {}, []
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        lines = (r["text"] or "").split("\n")
        keys, sizes = [x.rstrip(" ") for x in lines], [len(x.strip(" ")) for x in lines]
        own, gone = set(keys), set()
        for earlier, there in docs:
            if not own.isdisjoint(there):
                gone |= deleted(keys, earlier, sizes)
        docs.append((keys, own))
        out[r["doc_id"]] = sorted(gone)
    return out


def test_patience_against_its_definition():
    rng = random.Random(5)
    for _ in range(500):
        a, b = ([rng.randrange(9) for _ in range(rng.randrange(14))] for _ in range(2))
        assert line_dedup.patience(a, b) == matched(a, b)


def test_line_dedup_against_brute_force(docs, rows):
    gone = all_pairs(rows)
    got = {r["doc_id"]: r for r in line_dedup.dedup(docs).collect()}
    assert got.keys() == gone.keys()
    assert sum(map(bool, gone.values())) > 20
    for r in rows:
        lines = (r["text"] or "").split("\n")
        assert got[r["doc_id"]]["text"] == "\n".join(x for i, x in enumerate(lines) if i not in set(gone[r["doc_id"]])) or r["text"] is None
        assert got[r["doc_id"]]["removed_lines"] == len(gone[r["doc_id"]]) and got[r["doc_id"]]["lines"] == len(lines)


def test_line_dedup_edge_cases(edge, nothing):
    got = line_dedup.dedup(edge).collect()
    assert len(got) == edge.count()
    assert {r["removed_lines"] for r in got if r["doc_id"] == 1} == {0} and {(r["removed_lines"], r["text"]) for r in got if r["doc_id"] == 5} == {(2, "")}
    assert all(r["text"] is None for r in got if r["doc_id"] == 2)
    assert line_dedup.dedup(nothing).count() == 0


def removed(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r["_id"]: r["_gone"] for r in line_dedup.duplicate_lines(df).collect()}


def test_line_dedup_meets_more_than_the_earliest_holder(spark):
    a, b, c = ("a long enough line of text, number " + x for x in ("one", "two", "three"))
    short = "\n".join(f"a short line {i}" for i in range(6))
    assert removed(spark, [a, f"{a}\n{short}", f"{a}\n{short}"])[2] == list(range(7))
    assert removed(spark, [f"{a}\n{b}\n{c}", f"{c}\n{b}\n{a}", f"{c}\n{b}\n{a}"])[2] == [0, 1, 2]
    assert removed(spark, [f"{a}\n{b}\n{c}", f"{c}\n{b}\n{a}", f"{c}\n{b}\n{a}\nmore"])[2] == [0, 1, 2]
    # Shuffled long lines, so alignments cross; 400 documents, so several rounds are needed.
    rng = random.Random(8)
    pool = [f"line {i} of a pool of long enough lines" for i in range(12)]
    texts = ["\n".join([f"a line that the document {n} alone has", *rng.sample(pool, rng.randrange(1, 10))]) for n in range(400)]
    want = all_pairs([{"doc_id": i, "text": t} for i, t in enumerate(texts)])
    assert removed(spark, texts) == {i: g for i, g in want.items() if g}


def test_line_dedup_of_short_lines(spark):
    verse = [f"verse {i} of twenty" for i in range(20)]
    assert removed(spark, ["\n".join(verse)] * 2)[1] == list(range(20))
    assert removed(spark, ["\n".join(["own", *verse, "end"]), "\n".join(["other start", *verse[3:15], "", "no"])])[1] == list(range(1, 13))
    assert removed(spark, ["a\nb\nc", "a\nb\nc"]) == {}
    rng = random.Random(9)
    texts = ["\n".join(rng.choice(["", "x", "a short line", "eleven chars", "another short one", "a line of twenty-four or more"]) + rng.choice("  123") for _ in range(rng.randrange(14))) for _ in range(300)]
    want = all_pairs([{"doc_id": i, "text": t} for i, t in enumerate(texts)])
    assert removed(spark, texts) == {i: g for i, g in want.items() if g}


def test_line_dedup_against_all_pairs(docs, rows):
    got = {r["_id"]: r["_gone"] for r in line_dedup.duplicate_lines(docs).collect()}
    assert got == {i: g for i, g in all_pairs(rows).items() if g}
