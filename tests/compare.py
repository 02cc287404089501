"""Compare registered queries with their oracles: python tests/compare.py SF_DIR [name ...]"""

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v + 0.0)
        return repr(v)
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
         "boolean": "BOOLEAN"}


def check(spark, con, sf_dir, name, query, sql):
    """None when query and oracle agree, else a text that says where they differ."""
    df = query(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    if sql is None:
        return None if rows else "no rows"
    rel = con.sql(sql)
    want = rel.fetchall()
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} != {sorted(rel.columns)}"
    types = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    want_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    if types != want_types:
        return f"types {[(c, types[c], want_types[c]) for c in types if types[c] != want_types[c]]}"
    a, b = canonical(df.columns, rows), canonical(rel.columns, want)
    if a != b:
        only_a, only_b = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
        return f"rows {len(a)} vs {len(b)}\n   spark only {only_a}\n   duck only {only_b}"
    return None if a else "no rows"


def main():
    import __spark_entry__ as entry
    from tests.conftest import make_session
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark, con = make_session(), duck(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        t = time.time()
        try:
            problem = check(spark, con, sf_dir, name, queries[name], sql.get(name))
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {'D' if name in sql else 'R'} {name} {time.time() - t:.2f}s",
              problem or "", flush=True)
    print(f"{bad} failed")


if __name__ == "__main__":
    main()
