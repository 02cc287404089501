import datetime as dt
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapmart.functions.numbers import order_key, score_key
from snapmart.operators import clean, drift, features, fuzzy, lookup, metrics, ordering, rows, schema, splits
from snapmart.plans.gold import gold_snapshot


def pairs(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


# --- order statistics ----------------------------------------------------------------------
def test_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(1)
    data = {"a": np.array([1, 2, 3.5, 10, 11.25, 40, 7]), "b": rng.normal(0, 1, 3000), "c": np.repeat([5.0, -2.0], 400),
            "d": np.concatenate([rng.lognormal(0, 9, 2000), [0.0, -1e300, 1e300, 5e-324]])}
    table = [(n, float(v)) for n, vs in data.items() for v in vs] + [("a", float("nan")), ("b", None)]
    df = spark.createDataFrame(table, "n string, v double").repartition(7)
    cols = {n: F.when(F.col("n") == n, F.col("v")) for n in data} | {"empty": F.lit(None).cast("double")}
    probs = {"q1": 0.25, "m": 0.5, "q3": 0.75, "lo": 0.0, "hi": 1.0}
    got = ordering.exact_quantiles(df, cols, probs)
    assert "empty" not in got
    for n, vs in data.items():
        for name, q in probs.items():
            assert got[n][name] == pytest.approx(np.quantile(vs, q), rel=1e-12), (n, name)


def test_modes_take_the_smallest_of_ties(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("b", None), ("a", None), ("c", None)], "x string, y string")
    assert ordering.modes(df, ["x", "y"]) == {"x": "a", "y": None}


def test_running_sums_equal_brute_force(spark):
    rng = random.Random(3)
    data = [(rng.choice(["g", None]), rng.choice([0.1, 0.5, rng.random(), 1 - rng.random() * 1e-9, 1e-12 * rng.random()]), rng.randint(0, 3))
            for _ in range(3000)]
    df = spark.createDataFrame(data, "g string, v double, n int")
    got = ordering.running_sums(df, ["g"], "v", {"s": F.sum("n")}).collect()
    assert len(got) == len({(g, v) for g, v, _ in data})
    for r in random.Random(4).sample(got, 80) + got[:5]:
        mine = [(v, n) for g, v, n in data if g == r["g"]]
        assert r["s"] == sum(n for v, n in mine if v == r["v"])
        assert r["s_before"] == sum(n for v, n in mine if v < r["v"])
        assert r["s_total"] == sum(n for _, n in mine)


def test_running_sums_of_values_close_together(spark):
    """200,000 scores within 1e-6 of each other: they part into many small ranges, and their sums are exact."""
    n = 200_000
    df = spark.range(n).select((F.lit(0.3) + F.col("id") * 5e-12).alias("v"), (F.col("id") % 3).alias("n"))
    for key in (order_key, score_key):
        got = ordering.running_sums(df.repartition(4), [], "v", {"s": F.sum("n")}, key).orderBy("v").collect()
        want = itertools.accumulate(i % 3 for i in range(n))
        assert len(got) == n and all(r["s_before"] + r["s"] == w for r, w in zip(got, want, strict=True)) and got[0]["s_total"] == sum(i % 3 for i in range(n))
        cells = df.select(*[key(F.col("v"), bits).alias(f"r{bits}") for bits in ordering.LEVELS])
        outer = []
        for bits in (*ordering.LEVELS, None):
            inner = cells.groupBy(*outer, f"r{bits}").count().groupBy(*outer).count() if bits else cells.groupBy(*outer).count()
            assert inner.agg(F.max("count")).first()[0] <= 32_768
            outer.append(f"r{bits}")


# --- rows ----------------------------------------------------------------------------------
def test_keep_last_keeps_null_cells_and_ignores_partitioning(spark):
    data = [("a", 1, "x"), ("a", 3, None), ("a", 2, "y"), ("b", 5, "z")]
    df = spark.createDataFrame(data, "k string, ord_ int, v string")
    expected = {("a", 3, None), ("b", 5, "z")}
    for parts in (1, 4, 9):
        got = rows.keep_last(df.repartition(parts), "k", "ord_")
        assert {tuple(r) for r in got.collect()} == expected and got.columns == df.columns


def test_keep_unique_and_report(spark):
    df = spark.createDataFrame([("m", "a"), ("m", "a"), ("m", "b"), ("n", "c")], "s string, k string")
    assert pairs(rows.keep_unique(df, ["k"]), "s", "k") == [("m", "b"), ("n", "c")]
    report = pairs(rows.dedup_report(df, "s", "k"), "s", "rows_before", "rows_after", "dropped", "note")
    assert report == [("m", 3, 1, 2, "duplicates removed"), ("n", 1, 1, 0, "no duplicates")]


def test_drop_unknown_rows(spark):
    df = spark.createDataFrame([("a", 1.0, "x"), ("b", None, "x"), ("c", 2.0, "N / A"), ("d", float("nan"), "x"), ("e", 1.0, None)],
                               "k string, n double, t string")
    once = rows.drop_unknown_rows(df)
    assert pairs(once, "k") == [("a",)] and pairs(rows.drop_unknown_rows(once), "k") == [("a",)]
    assert pairs(rows.sanitize_tokens(df, protected=("k",)).filter("t is null"), "k") == [("c",), ("e",)]


def test_required_columns(spark):
    with pytest.raises(ValueError, match="snapdate"):
        rows.parse_snapshot_date(spark.range(1))


def test_empty_input(spark):
    df = spark.createDataFrame([], "customerID string, MonthlyCharges string, AverageDataUsage string, AppLoginFrequency string")
    assert clean.clean_financial(df).count() == 0
    assert rows.keep_last(df.withColumn("ord_", F.lit(1)), "customerID", "ord_").count() == 0


# --- cleaning ------------------------------------------------------------------------------
GOLDEN = {
    "gender": {"femalee": "female", "fmale": "female", "mal": "male", "unknown": None, None: None, "F": "female"},
    "Partner": {"es": "Yes", "yes!": None, "noo": None, "No.": "No", "✔": "Yes", "n/a": None, "": None},
    "EducationLevel": {"bachelur": "Bachelor", "phd": None, "High School": "HighSchool", "collega": "College"},
    "EmploymentStatus": {"unemployed": "Employed", "selfemployed": "Self-employed", "student": None},
    "AnnualIncomeBracket": {"60–100k": "60–100k", "150k": ">150k", ">15ok": ">150k", "unknown": None, "100—150k": "100–150k"},
}


def test_canonical_categories(spark):
    for column, mapping in GOLDEN.items():
        df = spark.createDataFrame([(i, raw) for i, raw in enumerate(mapping)], f"i int, {column} string")
        specs = {column: fuzzy.DEMOGRAPHIC_SPECS[column]}
        got = fuzzy.canonicalize(df, specs)
        assert [r[column] for r in got.orderBy("i").collect()] == list(mapping.values()), column


def test_numeric_policies(spark):
    df = spark.createDataFrame([(str(v),) for v in (1, 2, 3, 4, 5, 6, 7, -4, 7.5, 1000, "x", None)], "v string")
    def run(spec):
        return clean.clean_numeric(df.withColumn("i", F.monotonically_increasing_id()), {"v": spec}).orderBy("i").collect()
    clipped = run(clean.NumericSpec())
    base = [1, 2, 3, 4, 5, 6, 7, 0, 7.5, 1000]
    q1, q3 = np.quantile(base, [0.25, 0.75])
    upper = q3 + 3 * (q3 - q1)
    assert [r["v"] for r in clipped] == [*base[:-1], round(upper, 2), None, None]
    assert [r["v_was_outlier_high"] for r in clipped] == [False] * 9 + [True, False, False]
    assert clipped[7]["v_was_negative"] and clipped[7]["v_raw"] == "-4"
    nulled = run(clean.NumericSpec(negative="null", outlier="null"))
    assert [r["v"] for r in nulled][7:] == [None, 7.5, None, None, None]
    whole = run(clean.NumericSpec(whole="floor", outlier="clip", digits=None))
    assert whole[8]["v"] == 7 and whole[8]["v_was_fractional"] and isinstance(whole[9]["v"], int)
    assert run(clean.NumericSpec(whole="round", outlier="null", digits=None))[8]["v"] == 8
    refund = run(clean.REFUND_CHARGES)
    assert (refund[7]["v_refund"], refund[7]["v_paid_pos"], refund[7]["v"]) == (4.0, 0.0, -4.0)
    assert refund[10]["v_refund"] == 0.0 and refund[10]["v_paid_pos"] is None
    with pytest.raises(ValueError):
        clean.NumericSpec(negative="drop")


def test_all_null_column_has_no_fence(spark):
    df = spark.createDataFrame([("a", None), ("b", "-")], "customerID string, MonthlyCharges string")
    got = clean.clean_numeric(df, {"MonthlyCharges": clean.MONTHLY_CHARGES}).collect()
    assert all(r["MonthlyCharges"] is None and r["MonthlyCharges_was_outlier"] is False for r in got)


def test_contract_and_service(spark):
    df = spark.createDataFrame([("a", "UNKNOWN", "2024-05-01"), ("b", None, "bad"), ("b", None, "bad"), ("c", "One year", None)],
                               "customerID string, Contract string, snapdate string")
    assert pairs(clean.clean_contract(df), "customerID") == [("b",), ("c",)]
    service = spark.createDataFrame([("a", None), ("a", None), ("b", "x")], "customerID string, Plan string")
    assert pairs(clean.clean_service(service), "customerID", "Plan") == [("a", ""), ("b", "x")]


# --- lookup, vocabulary --------------------------------------------------------------------
def test_lookup_join_is_the_same_by_broadcast_and_by_shuffle(spark):
    df = spark.createDataFrame([("hot", i % 3) for i in range(300)] + [(None, 1), ("rare", 2)], "k string, v int")
    table = spark.createDataFrame([("hot", 1), ("rare", 2), ("unused", 3)], "k string, w int")
    small = lookup.lookup_join(df, lookup.staged_lookup(table), ["k"]).select("k", "v", "w")
    shuffled = lookup.lookup_join(df, table.hint("merge"), ["k"]).select("k", "v", "w")
    assert small.count() == 302 and small.exceptAll(shuffled).count() == 0 and shuffled.exceptAll(small).count() == 0


def test_rare_pooling_and_unknown(spark):
    train = spark.createDataFrame([("a",)] * 12 + [("b",)] * 3, "c string")
    vocabulary = lookup.staged_lookup(features.category_vocabulary(train, ["c"], 10))
    new = spark.createDataFrame([(1, "a"), (2, "b"), (3, "never")], "i int, c string")
    got = features.apply_vocabulary(new, ["c"], vocabulary).orderBy("i").collect()
    assert [r["c"] for r in got] == ["a", features.INFREQUENT, None]


# --- splits --------------------------------------------------------------------------------
@pytest.mark.parametrize("n,expected", [(15, (7, 3, 5)), (5, (0, 0, 5)), (4, (2, 1, 1)), (1, (0, 0, 1)), (9, (3, 1, 5))])
def test_time_split(spark, n, expected):
    months = [(dt.date(2023 + (1 + i) // 12, (1 + i) % 12 + 1, 1),) for i in range(n)]
    got = splits.time_split(spark.createDataFrame(months * 2, "snapdate date"))
    counts = {r["split"]: r["count"] // 2 for r in got.groupBy("split").count().collect()}
    assert tuple(counts.get(s, 0) for s in ("train", "test", "monitor")) == expected
    order = [r["split"] for r in got.orderBy("snapdate").collect()]
    assert order == sorted(order, key=["train", "test", "monitor"].index)


def test_stratified_split_is_exact_and_stable(spark):
    df = spark.createDataFrame([(i, int(i % 7 == 0)) for i in range(1500)], "k int, y int")
    one = splits.stratified_split(df, "y", "k").filter("part = 'test'")
    n = {0: sum(i % 7 != 0 for i in range(1500)), 1: sum(i % 7 == 0 for i in range(1500))}
    counts = {r["y"]: r["count"] for r in one.groupBy("y").count().collect()}
    assert counts == {y: -(-n[y] // 5) for y in n}
    assert pairs(one, "k") == pairs(splits.stratified_split(df.repartition(5), "y", "k").filter("part = 'test'"), "k")
    assert splits.stratified_split(df, "y", "k").count() == 1500


def test_stratified_split_of_months_with_repeated_customers(spark):
    df = spark.createDataFrame([(1 if i < 500 else i, f"m{i}", 1) for i in range(1000)] + [(None, "m", None)], "k int, month string, y int")
    got = splits.stratified_split(df, "y", ["k", "month"])
    assert {r["part"]: r["count"] for r in got.groupBy("part").count().collect()} == {"test": 200, "train": 801}


def test_distinct_ignores_the_ordinal(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", None, 2), ("b", "x", 3), ("b", "x", 4), ("b", "y", 5)], "customerID string, Contract string, ord_ int")
    assert pairs(clean.clean_contract(df), "customerID", "ord_") == [("a", 1), ("b", 3), ("b", 5)]
    assert clean.clean_service(df).count() == 3


def test_tables_with_equal_names(spark):
    from snapmart.plans.gold import join_tables

    a, b = (spark.createDataFrame([("k", v)], "customerID string, Plan string") for v in ("p", "q"))
    row = join_tables(a, b, "customerID").first()
    assert row.asDict() == {"customerID": "k", "Plan_x": "p", "Plan_y": "q"}


def test_months(spark):
    bounds = spark.createDataFrame([(dt.date(2023, 11, 5), dt.date(2024, 2, 1))], "start date, end date")
    calendar = splits.month_calendar(bounds)
    assert [m.isoformat() for (m,) in pairs(calendar, "month")] == ["2023-11-01", "2023-12-01", "2024-01-01", "2024-02-01"]
    df = spark.createDataFrame([(dt.date(2023, 12, 9),)], "snapdate date")
    assert len(pairs(splits.missing_months(df, calendar), "month")) == 3


def test_month_ranges_do_not_overlap(spark):
    df = spark.createDataFrame([(dt.date(2024, m, 15),) for m in range(1, 13)], "snapdate date")
    label = splits.month_range_label(F.col("snapdate"), {"train": ("2023-02-01", "2024-04-01"), "oot": ("2024-05-01", "2024-09-01")})
    got = [r["d"] for r in df.orderBy("snapdate").select(label.alias("d")).collect()]
    assert got == ["train"] * 4 + ["oot"] * 5 + [None] * 3


# --- metrics -------------------------------------------------------------------------------
def brute(y, p):
    y, p = np.array(y), np.array(p)
    pos, neg = p[y == 1], p[y == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    ap, last = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        tp = np.sum((p >= t) & (y == 1))
        ap += (tp / len(pos) - last) * tp / np.sum(p >= t)
        last = tp / len(pos)
    ks = max(abs(np.mean(pos <= t) - np.mean(neg <= t)) for t in set(p))
    return auc, ap, ks


def test_monthly_metrics_equal_brute_force(spark):
    rng = random.Random(8)
    data = [(m, rng.randint(0, 1), round(rng.random(), rng.choice([1, 2, 12]))) for m in ("a", "b") for _ in range(150)]
    data += [("one", 1, 0.2), ("one", 1, 0.9)]
    df = spark.createDataFrame(data, "m string, y int, p double")
    got = {r["m"]: r for r in metrics.monthly_metrics(df, ["m"]).collect()}
    for m in ("a", "b"):
        y, p = zip(*[(y, p) for g, y, p in data if g == m])
        r = got[m]
        assert (r["auc"], r["average_precision"], r["ks"]) == pytest.approx(brute(y, p), abs=1e-12)
        y, p = np.array(y), np.array(p)
        q = np.clip(p, 1e-7, 1 - 1e-7)
        assert r["brier"] == pytest.approx(np.mean((y - p) ** 2)) and r["pred_std"] == pytest.approx(np.std(p))
        assert r["logloss"] == pytest.approx(-np.mean(np.where(y == 1, np.log(q), np.log(1 - q))))
        assert r["accuracy"] == pytest.approx(np.mean((p >= 0.5) == y))
        tp = np.sum((p >= 0.5) & (y == 1))
        assert r["precision"] == pytest.approx(tp / np.sum(p >= 0.5)) and r["recall"] == pytest.approx(tp / y.sum())
    one = got["one"]
    assert all(one[c] is None for c in ("auc", "average_precision", "ks", "f1", "precision", "recall"))
    assert one["accuracy"] == 0.5 and one["n"] == 2 and one["negatives"] == 0


def test_auc_of_reversed_scores(spark):
    rng = random.Random(5)
    df = spark.createDataFrame([(rng.randint(0, 1), rng.randint(0, 64) / 64) for _ in range(400)], "y int, p double")
    a = metrics.ranking_metrics(df, [], ["auc"]).first()["auc"]
    b = metrics.ranking_metrics(df.withColumn("p", 1 - F.col("p")), [], ["auc"]).first()["auc"]
    assert a + b == pytest.approx(1.0)


def test_histogram_edges(spark):
    cells = [0.0, 0.1, 0.3, 0.6, 0.7, 1.0, 0.95, -0.1, 1.5]
    df = spark.createDataFrame([(c,) for c in cells], "p double")
    assert drift.bin_edges() == list(np.linspace(0, 1, 11))
    got = [r["n"] for r in drift.score_histogram(df, []).orderBy("bin").collect()]
    assert got == list(np.histogram(cells, bins=np.linspace(0, 1, 11))[0])
    assert [r["b"] for r in df.select(drift.bin_of(F.col("p")).alias("b")).collect()][:6] == [0, 1, 2, 5, 6, 9]


def test_psi(spark):
    rng = np.random.default_rng(2)
    e, a = rng.beta(2, 3, 500), np.append(rng.beta(3, 2, 400), 1.7)
    df = spark.createDataFrame([("expected", float(v)) for v in e] + [("actual", float(v)) for v in a], "s string, p double")
    edges = np.linspace(0, 1, 11)
    pe, pa = (np.where(h == 0, 0.0001, h) for h in (np.histogram(e, edges)[0] / len(e), np.histogram(a, edges)[0] / len(a)))
    assert drift.psi(df, F.col("s")).first()["psi"] == pytest.approx(np.sum((pa - pe) * np.log(pa / pe)))
    same = df.filter("s = 'expected'").unionByName(df.filter("s = 'expected'").withColumn("s", F.lit("actual")))
    assert drift.psi(same, F.col("s")).first()["psi"] == 0.0
    grades = spark.createDataFrame([(0.05,), (0.1,), (0.3,)], "v double").select(drift.psi_grade(F.col("v")).alias("g"))
    assert [r["g"] for r in grades.collect()] == ["good", "attention", "drifted"]


# --- schema --------------------------------------------------------------------------------
def test_schema_helpers(spark):
    df = spark.createDataFrame([("a", 1, 0.5, None), ("b", 0, 2.0, "x")], "customerID string, CHURN int, v double, t string")
    assert schema.label_column(df) == "CHURN" and schema.first_column(df, schema.KEY_NAMES) == "customerID"
    assert pairs(schema.binary_column_scan(df), "column", "is_binary") == [("CHURN", True), ("v", False)]
    assert schema.numeric_by_name(df).columns == ["CHURN", "v"]
    target = spark.createDataFrame([], "v double, extra double, customerID string").schema
    assert [tuple(r) for r in schema.align_to_schema(df, target).orderBy("customerID").collect()] == [(0.5, None, "a"), (2.0, None, "b")]
    assert schema.is_yes_no(spark.createDataFrame([("Yes",), (None,), ("no",)], "y string"), "y").first()[0]


def test_model_inputs(spark):
    df = spark.createDataFrame([(dt.date(2024, 5, 1), 1.0, None), (dt.date(2024, 5, 2), None, "x"), (dt.date(2024, 5, 3), 4.0, "x")],
                               "snapdate date, v double, t string")
    got = features.fill_missing(features.calendar_features(df)).orderBy("snapdate_day").collect()
    assert [r["v"] for r in got] == [1.0, 2.5, 4.0] and [r["t"] for r in got] == ["Unknown", "x", "x"]
    assert got[0]["snapdate_dayofweek"] == 2
    scaled = features.scale_by_std(spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double"), ["a", "b"])
    assert pairs(scaled, "a", "b") == [(1.0, 5.0), (3.0, 5.0)]


# --- gold ----------------------------------------------------------------------------------
def test_gold_snapshot_small(spark):
    labels = spark.createDataFrame([(" a", dt.date(2024, 1, 1), "Yes", 1), ("a", dt.date(2024, 1, 1), "No", 2), ("a", dt.date(2024, 2, 1), "No", 3),
                                    ("b", dt.date(2024, 1, 1), "unknown", 4), ("c", dt.date(2024, 1, 1), "Yes", 5)],
                                   "customerID string, snapdate date, Churn string, ord_ int")
    contract = spark.createDataFrame([("a", "x", dt.date(2020, 1, 1), 1), ("a", "n/a", dt.date(2020, 1, 1), 2), ("c", "y", dt.date(2020, 1, 1), 1)],
                                     "customerID string, Contract string, snapdate date, ord_ int")
    service = spark.createDataFrame([("a", "s1", 1), ("a", "s2", 2)], "customerID string, Plan string, ord_ int")
    got = gold_snapshot(labels, {"service": service, "contract": contract})
    assert got.columns == ["customerID", "snapdate", "Churn", "Contract", "contract_snapdate", "Plan"]
    assert pairs(got, "customerID", "snapdate", "Churn", "Contract", "Plan") == [
        ("a", dt.date(2024, 1, 1), "No", "x", "s2"), ("a", dt.date(2024, 2, 1), "No", "x", "s2")]


def joins_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_running_sums_and_gold_are_not_broadcast(spark):
    """Their tables grow with the rows, however few compressed bytes they are."""
    from pyspark.sql import functions as F

    from snapmart.operators.ordering import running_sums
    from snapmart.plans.gold import join_tables

    rows = spark.createDataFrame([("a", 0.5, 1), ("a", 0.25, 2), (None, 0.5, 3)], "g string, v double, n bigint")
    sums = running_sums(rows, ["g"], "v", {"n": F.sum("n")})
    assert {(r["g"], r["v"], r["n_before"], r["n_total"]) for r in sums.collect()} == {("a", 0.25, 0, 3), ("a", 0.5, 2, 3), (None, 0.5, 0, 3)}
    both = join_tables(rows, rows, "g")
    assert both.count() == 4
    for df in (sums, both):
        assert "Broadcast" not in joins_of(df) and "SortMergeJoin" in joins_of(df)


def test_quantiles_read_their_rows_once(spark):
    from pyspark.sql import functions as F

    from snapmart.operators.ordering import exact_quantiles

    read = spark.sparkContext.accumulator(0)

    def value(i):
        read.add(1)
        return float(i * 37 % 101)

    rows = spark.range(200).select(F.udf(value, "double")("id").alias("x"))
    values = sorted(float(i * 37 % 101) for i in range(200))
    assert exact_quantiles(rows, {"x": F.col("x")}, {"half": 0.5, "low": 0.0}) == {"x": {"half": (values[99] + values[100]) / 2, "low": values[0]}}
    assert read.value == 200


def test_rows_are_not_normalised_without_a_dictionary(spark):
    """Patterns are matched for distinct cells only; NULL cells and numbers meet the dictionary as texts."""
    from snapmart.operators.fuzzy import DEMOGRAPHIC_SPECS, canonicalize, category_dictionary

    rows = spark.createDataFrame([(" Femail", 1.0), (None, None), ("FEMALE", 0.0), ("male ", 1.0), (" male", 2.0)], "gender string, Partner double")
    specs = {c: DEMOGRAPHIC_SPECS[c] for c in rows.columns}
    out = canonicalize(rows, specs)
    assert [(r["gender"], r["Partner"]) for r in out.collect()] == [("female", "Yes"), (None, None), ("female", "No"), ("male", "Yes"), ("male", None)]
    assert "regexp_replace" not in joins_of(out)
    assert category_dictionary(rows.unionByName(rows), specs).count() == 6
