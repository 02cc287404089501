import hashlib

from pyspark.sql import functions as F

from snapmart.llm import fingerprints as fp
from tests.llm.conftest import SF


def shingles(text):
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", text) if x]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_edited_texts_and_likeness(spark, docs, rows):
    got = {r["doc_id"]: r for r in fp.edited_fingerprints(docs).collect()}
    ordered = sorted(rows, key=lambda r: -r["doc_id"])
    assert len(got) == len(rows)
    worst = 0
    for r, n in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        text, nxt = r["text"] or "", n["text"] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + nxt[:half]
        g = got[r["doc_id"]]
        assert g["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and g["n_chars"] == len(text)
        worst = max(worst, abs(g["near_edited"] - jaccard(shingles(text), shingles(edited))), abs(g["near_next"] - jaccard(shingles(text), shingles(nxt))))
        assert (g["fingerprint"] == got[n["doc_id"]]["fingerprint"]) or text != nxt
    assert worst < 0.2


def test_ranges_of_ids_and_boundaries(spark, monkeypatch):
    monkeypatch.setattr(fp, "ROWS_PER_RANGE", 2)
    df = spark.createDataFrame([(i * i * 37 % 1009, f"text number {i} of this table is here") for i in range(300)], "doc_id bigint, text string").dropDuplicates(["doc_id"])
    got = {r["doc_id"]: r["edited_sha256"] for r in fp.edited_fingerprints(df).collect()}
    ordered = sorted(df.collect(), key=lambda r: -r["doc_id"])
    for r, n in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        half = len(r["text"]) // 2
        assert got[r["doc_id"]] == hashlib.sha256((r["text"][:len(r["text"]) - half] + n["text"][:half]).encode()).hexdigest()


def test_sketches_merge_and_estimate(spark):
    a = " ".join(f"a{i}" for i in range(2000))
    b = " ".join(f"a{i}" for i in range(1000, 2600))
    row = spark.createDataFrame([(a, b, a + " " + b)], "a string, b string, c string").select(
        fp.sketch(F.col("a")).alias("a"), fp.sketch(F.col("b")).alias("b")).select(
        fp.resemblance(F.col("a"), F.col("b")).alias("r"), fp.containment(F.col("b"), F.col("a")).alias("c"), fp.distinct_shingles(F.col("a")).alias("d"),
        (fp.from_text(fp.as_text(F.col("a"))) == F.col("a")).alias("same"),
        (fp.merged(F.col("a"), F.col("b")) == fp.merged(F.col("b"), F.col("a"))).alias("order")).first()
    assert abs(row["r"] - 996 / 2596) < 0.15 and abs(row["c"] - 996 / 1596) < 0.25 and abs(row["d"] / 1996 - 1) < 0.3 and row["same"] and row["order"]


def test_edge_cases(edge, nothing):
    got = fp.edited_fingerprints(edge).collect()
    assert len(got) == edge.count() and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert {r["fingerprint"] for r in got if r["n_chars"] == 0} == {""}
    assert fp.edited_fingerprints(nothing).count() == 0 and fp.fingerprints(edge).count() == edge.count()
    single = edge.where("doc_id = 7")
    assert fp.edited_fingerprints(single).first()["edited_sha256"] == hashlib.sha256(b"x").hexdigest()


def test_query_reads_the_whole_table(spark):
    from snapmart.llm.queries import registered

    assert registered()["op3_document_fingerprints"](spark, SF).count() == 1000
