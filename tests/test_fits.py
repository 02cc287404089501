"""Stored dictionaries that grow and stored fences, against fits of the whole table at once."""

import pytest

from snapmart.operators import clean, fuzzy
from snapmart.plans.layers import run_layers, run_ledgered_layers
from snapmart.sources.fits import Fits
from snapmart.sources.layers import layer_path

COLUMNS = "customerID string, gender string, Partner string, EducationLevel string, ord_ int"
ROWS = [("a", "femail", "yes", "colege", 1), ("b", "xyz", "No.", "phd", 2), ("c", "MALE", None, "College", 3), ("d", "femail", "Yep", "bachelur", 4),
        ("e", "gemale", "是", "highschol", 5), ("f", None, "", "phd", 6), (" ", "m", "1", "x", 7)]


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(ROWS, COLUMNS).repartition(3).cache()


def cleaned(df, **options):
    return sorted(map(tuple, clean.clean_demographic(df, **options).collect()))


def test_a_grown_dictionary_equals_one_of_all_rows(spark, people, tmp_path):
    fits = Fits(spark, str(tmp_path))
    assert fits.dictionary().count() == 0
    for part, versions in ((people.filter("ord_ <= 2"), {1}), (people.filter("ord_ <= 4"), {1, 2}), (people, {1, 2, 3}), (people, {1, 2, 3}), (people.limit(0), {1, 2, 3})):
        grown = fits.grow(part, fuzzy.DEMOGRAPHIC_SPECS)
        assert {r["version"] for r in grown.select("version").distinct().collect()} == versions
    texts = [(r["column"], r["text"]) for r in grown.collect()]
    everything = fuzzy.distinct_texts(people, {c: s for c, s in fuzzy.DEMOGRAPHIC_SPECS.items() if c in people.columns})
    assert len(texts) == len(set(texts)) and set(texts) == {(r["column"], r["text"]) for r in everything.collect()}
    assert cleaned(people, dictionary=grown) == cleaned(people)
    assert {r["text"] for r in fits.dictionary(1).filter("column = 'gender'").collect()} == {"femail", "xyz"}


def test_only_new_texts_are_scored(spark, people, tmp_path, monkeypatch):
    scored = []
    monkeypatch.setattr("snapmart.sources.fits.valued", lambda texts, specs: scored.append(sorted((r["column"], r["text"]) for r in texts.collect())) or fuzzy.valued(texts, specs))
    fits = Fits(spark, str(tmp_path))
    fits.grow(people.filter("ord_ <= 2").select("gender"), fuzzy.DEMOGRAPHIC_SPECS)
    fits.grow(people.filter("ord_ <= 4").select("gender"), fuzzy.DEMOGRAPHIC_SPECS)
    assert scored == [[("gender", "femail"), ("gender", "xyz")], [("gender", "male")]]


def test_fences_belong_to_a_state_of_the_table(spark, tmp_path):
    spec = {"v": clean.NumericSpec(), "w": clean.NumericSpec()}
    df = spark.createDataFrame([(str(i), None) for i in range(100)], "v string, w string")
    fits = Fits(spark, str(tmp_path))
    first = fits.fences(df, spec, "one")
    assert first == clean.iqr_fences(df, spec) and set(first) == {"v"}
    assert fits.fences(df.limit(0), spec, "one") == first
    second = fits.fences(df.limit(50), spec, "two")
    assert second != first and fits.fences(df, spec, "one") == first and fits.fences(df, spec, "two") == second
    assert sorted(p.name for p in (tmp_path / "fences").glob("version=*")) == ["version=1", "version=2"]


def test_ledgered_layers_equal_plain_ones(spark, people, tmp_path):
    def money(n):
        return spark.createDataFrame([(r[0], str(10 * i if i < n else 5000), "3.5", "4", "5", i) for i, r in enumerate(ROWS)],
                                     "customerID string, MonthlyCharges string, AverageDataUsage string, AppLoginFrequency string, CustomerSatisfactionScore string, ord_ int")

    labels = spark.createDataFrame([(c, "2024-05-01", "Yes", i) for i, c in enumerate("abcdef")], "customerID string, snapdate string, Churn string, ord_ int")
    root = str(tmp_path / "kept")
    for k, tables in enumerate(({"label": labels, "demographic": people.filter("ord_ < 4"), "financial": money(6)}, {"label": labels, "demographic": people, "financial": money(7)})):
        run_ledgered_layers(spark, tables, root)
        run_layers(spark, tables, str(tmp_path / f"plain{k}"))
        for layer, name in (("silver", "demographic"), ("silver", "financial"), ("gold", "gold")):
            one, other = (spark.read.parquet(layer_path(r, layer, name)) for r in (root, str(tmp_path / f"plain{k}")))
            assert one.columns == other.columns and sorted(map(repr, one.collect())) == sorted(map(repr, other.collect()))
    assert sorted(p.name for p in (tmp_path / "kept/fits/dictionary").glob("version=*")) == ["version=1", "version=2"]
