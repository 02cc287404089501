import datetime as dt
import json
import shutil

import pytest
from pyspark.sql import functions as F

from snapmart.operators.rows import keep_last
from snapmart.plans.layers import layer_row_counts, run_layers, run_ledgered_layers
from snapmart.plans.training import training_frame
from snapmart.session import shared_dir, stage
from snapmart.sources import csv, layers
from snapmart.sources.ledger import Ledger, contents

TABLE = "﻿customerID,AnnualIncome Bracket,snapdate\nC1,60–100k,2024-01-01\nC2,无,NaN\nC1,\"a, b\",N/A\n"


@pytest.mark.parametrize("encoding", ["utf-8", "gb18030"])
def test_csv_encodings(spark, tmp_path, encoding):
    path = tmp_path / "t.csv"
    text = TABLE if encoding == "utf-8" else TABLE.lstrip("﻿")
    path.write_bytes(text.encode(encoding))
    assert csv.detect_encoding(spark, str(path)) == encoding
    df = csv.read_csv_any(spark, str(path))
    assert df.columns == ["customerID", "AnnualIncome Bracket", "snapdate", "ord_"]
    rows = df.orderBy("ord_").collect()
    assert [r[1] for r in rows] == ["60–100k", "无", "a, b"] and [r["snapdate"] for r in rows] == ["2024-01-01", None, None]
    last = {r["customerID"]: r[1] for r in keep_last(df, "customerID", "ord_").collect()}
    assert last == {"C1": "a, b", "C2": "无"}


def test_csv_western_encoding(spark, tmp_path):
    path = tmp_path / "w.csv"
    path.write_bytes("k,v\n1,caf\xe9\n2,\xff\n".encode("cp1252"))
    assert csv.detect_encoding(spark, str(path)) == "windows-1252"
    assert [r["v"] for r in csv.read_csv_any(spark, str(path), order=None).orderBy("k").collect()] == ["café", "ÿ"]
    with pytest.raises(ValueError):
        csv.detect_encoding(spark, str(path), ("utf-8",))


def test_each_file_in_its_own_encoding(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("k,v\n1,caf\u00e9\u65e0\n".encode("utf-8"))
    (tmp_path / "b.csv").write_bytes("k,v\n2,\u65e0\u660e\n".encode("gb18030"))
    assert {e: len(f) for e, f in csv.detect_encodings(spark, str(tmp_path)).items()} == {"utf-8": 1, "gb18030": 1}
    assert [r["v"] for r in csv.read_csv_any(spark, str(tmp_path)).orderBy("k").collect()] == ["caf\u00e9\u65e0", "\u65e0\u660e"]


def test_records_over_several_lines_are_read_or_refused(spark, tmp_path):
    (tmp_path / "q.csv").write_text('k,v\n1,"a\nb"\n2,"c ""d"""\n')
    with pytest.raises(ValueError, match="multi_line"):
        csv.read_csv_any(spark, str(tmp_path))
    got = csv.read_csv_any(spark, str(tmp_path), multi_line=True, order=None).orderBy("k").collect()
    assert [r["v"] for r in got] == ["a\nb", 'c "d"']


def test_bronze_reads_the_date_format_off_the_data(spark, tmp_path):
    from snapmart.plans.layers import run_bronze

    labels = spark.createDataFrame([("a", "2024/05/01", "Yes"), ("b", "2024/06/01", "No"), ("c", "?", "No")], "customerID string, snapdate string, Churn string")
    assert run_bronze(spark, {"label": labels}, str(tmp_path / "x")).get == {"n_rows": 3, "n_bad": 1}
    with pytest.raises(ValueError, match="no snapshot date"):
        run_bronze(spark, {"label": labels.filter("customerID = 'c'")}, str(tmp_path / "y"))


def test_many_bad_values_before_the_dates_reject_nothing_else(spark, tmp_path):
    from snapmart.plans.layers import run_bronze

    rows = [(f"c{i}", f"bad {i}", "No", i) for i in range(1500)] + [(f"c{i}", f"2024/{1 + i % 12:02d}/01", "Yes", i) for i in range(1500, 21500)]
    rows.append(("last", "2024-05-01", "No", 30000))
    for k, frame in enumerate((rows, rows[::-1])):
        labels = spark.createDataFrame(frame, "customerID string, snapdate string, Churn string, ord_ long")
        for j, df in enumerate((labels, labels.drop("ord_"))):
            assert run_bronze(spark, {"label": df}, str(tmp_path / f"x{k}{j}")).get == {"n_rows": 21501, "n_bad": 1501}


def test_elected_formats(spark):
    from snapmart.operators.formats import elect_format, elect_formats, format_votes

    made = [(5, "1/6/2024", "2024-13-01"), (2, "20240105", None), (9, "1/7/2024", "x"), (7, None, "2024_01_31"), (1, "13/45/2024", "")]
    df = spark.createDataFrame(made, "k long, a string, b string")
    assert elect_formats(df, ["a", "b"], "k") == {"a": "yyyyMMdd", "b": "yyyy_MM_dd"}
    assert elect_formats(df, ["a", "b"]) == {"a": "M/d/yyyy", "b": "yyyy_MM_dd"}
    votes = {(v["column"], v["format"]): (v["n"], v["first"]) for v in format_votes(df, ["a", "b"], "k").collect()}
    assert votes == {("a", "M/d/yyyy"): (2, 5), ("a", "yyyyMMdd"): (1, 2), ("b", "yyyy_MM_dd"): (1, 7)}
    assert elect_formats(df.limit(0), ["a"], "k") == {"a": "yyyy-MM-dd"} and elect_formats(df, []) == {}
    assert elect_format(df.selectExpr("DATE'2024-01-01' AS snapdate")) == elect_format(df) == "yyyy-MM-dd"
    with pytest.raises(ValueError, match="missing column"):
        elect_formats(df, ["z"])


def test_feature_tables_are_read_in_their_own_formats(spark, tmp_path):
    from snapmart.plans.layers import run_layers
    from snapmart.sources.layers import layer_path

    names = ("demographic", "contract", "service")
    inputs = {"label": spark.createDataFrame([("a", "2024-05-01", "Yes", 1), ("b", "2024-05-01", "No", 2)], "customerID string, snapdate string, Churn string, ord_ long")}
    shapes = dict(zip(names, ("20240503", "2024/05/04", "5/5/2024"), strict=True))
    for name, text in shapes.items():
        inputs[name] = spark.createDataFrame([("a", "?", "x", 1), ("b", text, "y", 2)], f"customerID string, snapdate string, {name}_v string, ord_ long")
    run_layers(spark, inputs, str(tmp_path))
    for name, day in zip(names, (3, 4, 5), strict=True):
        got = {r["customerID"]: r["snapdate"] for r in spark.read.parquet(layer_path(str(tmp_path), "silver", name)).collect()}
        assert got == {"a": None, "b": dt.date(2024, 5, day)}


def test_gold_duplicates_go_in_place(spark, tmp_path):
    from snapmart.plans.layers import run_gold_dedup
    from snapmart.sources.layers import layer_path, read_snapshots, write_snapshots

    gold = spark.createDataFrame([("a", dt.date(2024, 5, 1), 1), ("a", dt.date(2024, 5, 1), 2), ("b", dt.date(2024, 5, 1), 3), ("a", dt.date(2024, 6, 1), 4)],
                                 "customerID string, snapdate date, v int")
    path = layer_path(str(tmp_path), "gold", "gold")
    write_snapshots(gold, path)
    report = {r["snapdate"].month: r["dropped"] for r in run_gold_dedup(spark, str(tmp_path)).collect()}
    assert report == {5: 2, 6: 0} and sorted(r["v"] for r in read_snapshots(spark, path).collect()) == [3, 4]


def test_guarded_read(spark, tmp_path):
    assert csv.read_csv_if_ready(spark, str(tmp_path / "none.csv"), "customerID") is None
    path = tmp_path / "t.csv"
    path.write_text("id,v\n1,2\n")
    assert csv.read_csv_if_ready(spark, str(path), "customerID") is None
    assert csv.read_csv_if_ready(spark, str(path), "id").count() == 1


def test_named_files_and_newest(spark, tmp_path):
    for name in ("gold_2024_05_01.csv", "gold_2024_06_01.csv", "gold_2024_13_01.csv", "other.csv"):
        (tmp_path / name).write_text(f"k\n{name}\n")
    got = layers.read_named_files(spark, str(tmp_path))
    assert sorted((r["k"], r["snapdate"].month) for r in got.collect()) == [("gold_2024_05_01.csv", 5), ("gold_2024_06_01.csv", 6)]
    import os
    for i, name in enumerate(sorted(os.listdir(tmp_path))):
        os.utime(tmp_path / name, (1_700_000_000 + i, 1_700_000_000 + i))
    assert layers.newest_file(spark, str(tmp_path)).endswith("other.csv")


def test_snapshots_prune_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "gold")
    df = spark.createDataFrame([(i, dt.date(2024, i % 4 + 1, 1)) for i in range(40)], "k int, snapdate date")
    layers.write_snapshots(df, path)
    some = layers.read_snapshots(spark, path, "2024-02-01", "2024-03-01", required=True)
    assert some.count() == 20
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapdate" in plan
    with pytest.raises(ValueError):
        layers.read_snapshots(spark, path, "2030-01-01", "2030-02-01", required=True)
    layers.overwrite_snapshots(df.filter("snapdate = date '2024-02-01'").limit(3), path)
    assert {r["snapdate"].month: r["count"] for r in layers.read_snapshots(spark, path).groupBy("snapdate").count().collect()} == {
        1: 10, 2: 3, 3: 10, 4: 10}


def test_promote_reports_missing_and_goes_on(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.range(5).write.parquet(source)
    missing = layers.promote(spark, {"absent": str(tmp_path / "no"), "there": source}, str(tmp_path), "bronze")
    assert missing == ["absent"] and spark.read.parquet(layers.layer_path(str(tmp_path), "bronze", "there")).count() == 5


def test_exports(spark, tmp_path):
    df = spark.range(3).coalesce(1)
    csv.write_csv(df, str(tmp_path / "c"))
    layers.write_json(df, str(tmp_path / "j"))
    assert spark.read.csv(str(tmp_path / "c"), header=True).count() == 3
    lines = [json.loads(x) for f in (tmp_path / "j").glob("*.json") for x in f.read_text().splitlines()]
    assert sorted(x["id"] for x in lines) == [0, 1, 2]


def test_stage_uses_the_shared_folder(spark):
    assert shared_dir(spark)
    df = stage(spark.range(10).withColumn("x", F.col("id") * 2))
    assert df.count() == 10 and "Scan ExistingRDD" in df._jdf.queryExecution().executedPlan().toString()


def test_layers_from_small_tables(spark, tmp_path):
    inputs = {
        "label": spark.createDataFrame([("a", "2024-01-01", "Yes", 1), ("a", "bad", "No", 2), ("b", "2024-02-01", "0.8", 3)],
                                       "customerID string, snapdate string, Churn string, ord_ int"),
        "contract": spark.createDataFrame([("a", "One year", 1), ("b", "unknown", 2)], "customerID string, Contract string, ord_ int"),
    }
    rejected = run_layers(spark, inputs, str(tmp_path))
    assert rejected.get == {"n_rows": 3, "n_bad": 1}
    counts = {(r["layer"], r["table"]): r["n"] for r in layer_row_counts(spark, str(tmp_path), list(inputs)).collect()}
    assert counts == {("bronze", "label"): 2, ("bronze", "contract"): 2, ("silver", "label"): 2, ("silver", "contract"): 1, ("gold", "gold"): 1}
    gold = layers.read_snapshots(spark, layers.layer_path(str(tmp_path), "gold", "gold"))
    got = training_frame(gold, "2023-02-01", "2024-04-01", order=None).collect()
    assert [(r["customerID"], r["Churn"]) for r in got] == [("a", 1)]


def small_tables(spark, day="2024-02-01", extra=()):
    return {
        "label": spark.createDataFrame([("a", "2024-01-01", "Yes", 1), ("a", "bad", "No", 2), ("b", day, "No", 3)], "customerID string, snapdate string, Churn string, ord_ int"),
        "contract": spark.createDataFrame([("a", "One year", 1), ("b", "One year", 2), ("c", "unknown", 3), *extra], "customerID string, Contract string, ord_ int"),
    }


def files(root):
    return {str(f.relative_to(root)): f.stat().st_mtime_ns for f in root.rglob("*.parquet") if f.relative_to(root).parts[0] != "ledger"}


def test_ledger_skips_what_did_not_change(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path))
    assert ledger.entries().count() == 0 and ledger.newest("stage", "gold/gold") is None
    run_ledgered_layers(spark, small_tables(spark), str(tmp_path))
    first = files(tmp_path)
    got = {r["stage"]: (r["rows_in"], r["rows_out"], r["rejected"]) for r in ledger.entries().collect()}
    assert got == {"bronze/label": (3, 2, 1), "bronze/contract": (3, 3, 0), "silver/label": (2, 2, 0), "silver/contract": (3, 2, 1), "gold/gold": (2, 2, 0)}
    # The same rows in another order and other partitions write nothing at all.
    again = {n: df.orderBy(F.desc("ord_")).repartition(3) for n, df in small_tables(spark).items()}
    run_ledgered_layers(spark, again, str(tmp_path))
    assert files(tmp_path) == first and ledger.entries().count() == 5
    # A changed contract is ingested and cleaned again, and gold joined; the labels stay.
    run_ledgered_layers(spark, small_tables(spark, extra=[("a", "Two year", 4)]), str(tmp_path))
    changed = files(tmp_path)
    assert ledger.entries().count() == 8 and {k: v for k, v in changed.items() if "label" in k} == {k: v for k, v in first.items() if "label" in k}
    assert not set(first) & {k for k in changed if "label" not in k}
    # What a stage wrote is gone: it runs again though its inputs are the same, and so does nothing before it.
    shutil.rmtree(tmp_path / "gold")
    run_ledgered_layers(spark, small_tables(spark, extra=[("a", "Two year", 4)]), str(tmp_path))
    assert ledger.entries().count() == 9 and files(tmp_path).keys() >= {k for k in changed if k.split("/")[0] != "gold"}
    run_ledgered_layers(spark, small_tables(spark, day="2024-03-01", extra=[("a", "Two year", 4)]), str(tmp_path))
    assert Ledger(spark, str(tmp_path)).newest("stage", "gold/gold")["rows_out"] == 2 and ledger.entries().count() == 12


def test_a_failed_stage_leaves_no_entry(spark, tmp_path):
    tables = small_tables(spark)
    tables["label"] = tables["label"].filter("snapdate = 'bad'")
    with pytest.raises(ValueError, match="no snapshot date"):
        run_ledgered_layers(spark, tables, str(tmp_path))
    assert Ledger(spark, str(tmp_path)).entries().count() == 0
    tables = small_tables(spark)
    for _ in range(2):
        run_ledgered_layers(spark, tables | {"contract": tables["contract"].limit(0)}, str(tmp_path))
        got = {r["stage"]: (r["rows_in"], r["rows_out"]) for r in Ledger(spark, str(tmp_path)).entries().collect()}
        assert got == {"bronze/label": (3, 2), "bronze/contract": (0, 0), "silver/label": (2, 2), "silver/contract": (0, 0), "gold/gold": (2, 0)}
    assert Ledger(spark, str(tmp_path)).entries().count() == 5


def test_fingerprints_tell_rows(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "b", None)], "k int, x string, y string")
    same = contents(df)
    assert contents(df.orderBy(F.desc("k")).repartition(2)) == same and same.rows == 2
    others = [df.limit(1), df.union(df), df.withColumn("x", F.col("y")).withColumn("y", F.lit(None).cast("string")), df.withColumnRenamed("x", "z"),
              df.withColumn("k", F.col("k").cast("long")), spark.createDataFrame([(1, "a", None), (2, "b", None)], df.schema)]
    assert len({same.fingerprint, *(contents(o).fingerprint for o in others)}) == 1 + len(others)


def test_training_frame_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "gold")
    df = spark.createDataFrame([(f" C{i}", dt.date(2023, i % 12 + 1, 1), "Yes", i) for i in range(24)],
                               "customerID string, snapdate date, Churn string, ord_ int")
    layers.write_snapshots(df, path)
    got = training_frame(layers.read_snapshots(spark, path), "2023-03-01", "2023-04-01")
    assert got.count() == 4
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "snapdate#" in plan.split("PartitionFilters: [")[1].split("]")[0] and "2023-03-01" in plan.split("PartitionFilters: [")[1][:400]
