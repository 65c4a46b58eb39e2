import pytest

TEXTS = [
    (1, "Alpha beta gamma delta epsilon. " * 8, "a", "x"),
    (2, None, "a", "y"),
    (3, "", None, "y"),
    (4, "Alpha beta gamma delta epsilon. " * 8, "b", None),
    (4, "Alpha beta gamma delta epsilon. " * 8, "b", None),
    (None, "one two three four five six seven", "b", "x"),
    (9007199254740993, "line\n\n line \x0b word\n" + "z" * 30_000, "c", "x"),
    (6, "Ünï çödé 𝔘 words\tand more " * 30, None, "x"),
]


@pytest.fixture
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and columns with clashing names."""
    schema = "doc_id long, text string, source string, size string"
    return spark.createDataFrame(TEXTS, schema).selectExpr("*", "1 AS score", "2 AS _key", "3 AS at", "'q' AS gap")


@pytest.fixture
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def texts(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] or "" for r in rows}
