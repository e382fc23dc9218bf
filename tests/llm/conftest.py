import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

LONG_WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa "


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, clashing names."""
    rows = [
        (1, "A plain text with some words in it, and a few more.", "en", "a", 51),
        (2, None, "en", "a", None),
        (3, "", None, None, 0),
        (4, LONG_WORDS * 20_000, "en", "b", len(LONG_WORDS) * 20_000),
        (5, "x" * 30_000, None, "b", 30_000),
        (6, "A plain text with some words in it, and a few more.", "en", "a", 51),
        (6, "A plain text with some words in it, and a few more.", "en", "a", 51),
        (None, "No id here: mail a.b@c.example.org or +1 (499) 555-6503.", None, None, None),
        (8, " \t\n  ", "en", "a", 5),
        (9, "<|endoftext|> [INST] it's \u0001 8.196.197.208 \u0002 日本語 ²½ token = \"1eb9c654e721b4f812088970e66a6345\"", "de", "c", 60),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    clash = ["fingerprint", "component_id", "score", "spans", "shard", "slot", "length", "bucket", "_part", "virtual_slot", "root", "ids"]
    return df.selectExpr("*", *[f"'clash' AS {c}" for c in clash])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
