"""The registered queries on the smallest tables: columns of their contracts, and SQL where there is any."""

import pytest

import __spark_entry__ as entry
from snapmart.llm.queries import CHECKS, oracle_sql, registered
from tests.compare import check, duck

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": "doc_id piece:int start:bigint length:bigint ids_crc32:bigint sequence_id:bigint offset:bigint", "op2": "doc_id class_id n_links:bigint",
    "op3": "doc_id n_chars:bigint edited_sha256:string fingerprint:string edited_fingerprint:string near_edited:double near_next:double",
    "op4": "doc_id n_bytes:bigint n_removed:bigint n_spans:bigint kept_sha256:string", "op5": "query_id:bigint rank:int vec_id:bigint score:double",
    "op6": "doc_id n_assign:bigint n_access:bigint n_hex:bigint base_sha256:string spans:string", "op7": "doc_id removed_lines:bigint kept_sha256:string",
    "op8": "doc_id size:bigint source_size:bigint target:double taken:bigint", "op9": "doc_id held_out:boolean score:double predicted:int",
    "op10": "doc_id held_out:boolean score:double predicted:int", "op11": "doc_id held_out:boolean lang_pred:string score:double",
    "op12": "vec_id component:int n:bigint deviation:bigint whitened:double explained:double identity_error:double", "op13": "item_id rank:int doc_id score:bigint", "pipeline": "doc_id piece:int sequence_id:bigint"}


def test_names():
    checks = {f.__name__ for f in CHECKS}
    assert {n.partition("_")[0] for n in registered() if n not in checks} | {"pipeline"} == set(COLUMNS) and checks <= set(oracle_sql())
    assert set(registered()) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", [*registered(), "pipeline"])
def test_query(spark, name):
    df = entry.queries()[name](spark, SF_DIR)
    kinds = dict(df.dtypes)
    for column in COLUMNS.get(name.partition("_")[0], "").split():
        column, _, kind = column.partition(":")
        assert kinds[column] == (kind or "bigint")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    if name in oracle_sql():
        assert check(spark, duck(SF_DIR), SF_DIR, name, entry.queries()[name], oracle_sql()[name]) is None
    elif name in ("op1_best_fit_packing", "op12_embedding_whitening", "pipeline"):
        assert df.count() > 0
    else:
        assert df.count() == docs.count()
