import pytest

import corpus_pipeline as cp
from snapmart.llm import ngram_join
from tests.llm.conftest import SF

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, docs, tmp_path_factory):
    out, df = [], docs
    for name, stage in cp.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, df, SF).write.parquet(path)
        df = spark.read.parquet(path)
        out.append(df)
    return out


def test_stages_keep_the_columns_and_lose_no_clean_documents(spark, docs, stages):
    toxic, lines, near, mixed, packed = stages
    for df in stages[:4]:
        assert df.columns == COLUMNS
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    clean = labels.where("toxic = 0").join(docs, "doc_id").count()
    assert toxic.join(labels.where("toxic = 0"), "doc_id").count() >= 0.99 * clean
    assert toxic.join(labels.where("toxic = 1"), "doc_id").count() <= 0.4 * labels.where("toxic = 1").count()
    ids = {r["doc_id"] for r in lines.select("doc_id").collect()}
    gone = [r for r in toxic.collect() if r["doc_id"] not in ids]
    kept = {x for r in lines.collect() for x in (r["text"] or "").split("\n")}
    assert gone and all(x.rstrip() in {k.rstrip() for k in kept} for r in gone for x in r["text"].split("\n") if len(x.strip()) >= 24)


def test_one_of_each_group_stays(stages):
    _, lines, near, _, _ = stages
    classes = {(r["doc_id"], r["class_id"]) for r in ngram_join.join(lines).collect()}
    assert sorted(r["doc_id"] for r in near.collect()) == sorted(i for i, c in classes if i == c)


def test_mix_takes_whole_copies_and_packing_takes_all(stages):
    _, _, near, mixed, packed = stages
    before = {r["doc_id"]: r["text"] for r in near.collect()}
    rows = mixed.collect()
    assert all(before[r["doc_id"]] == r["text"] for r in rows)
    pieces = packed.collect()
    assert sum(r["piece"] == 0 for r in pieces) == len(rows)
    fill = {}
    for r in pieces:
        fill.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_edge_cases(spark, edge, nothing, tmp_path):
    spark.createDataFrame([(1, None, 0), (4, 1, 1), (None, 1, 1)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for df in (edge.select(*COLUMNS), nothing):
        for name, stage in cp.STAGES:
            df = stage(spark, df, str(tmp_path))
            df.count()
