import pytest

SF = "/root/testdata/sf0.01"
EDGE = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="session")
def rows(docs):
    return [r.asDict() for r in docs.collect()]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
    made = [(1, "one two three four five six\nseven eight nine ten eleven twelve", "en", "a", 1), (1, "one two three four five six\nseven eight nine ten eleven twelve", "en", "a", 1),
            (2, None, None, None, None), (3, "", "en", "b", 0), (4, long, "en", "a", len(long)), (None, "no id here but a text of some words", "en", None, 5),
            (None, None, None, None, None), (5, "one two three four five six\nseven eight nine ten eleven twelve", "de", "b", 1), (6, "   \n\n \t", "en", "a", 6),
            (7, "x", "en", "b", 1), (8, long + " end", "en", "a", 3)]
    base = spark.createDataFrame(made, EDGE)
    return base.selectExpr("*", "1 AS size", "'x' AS score", "2 AS target", "'y' AS fingerprint", "3 AS lines", "4 AS spans")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], EDGE)
