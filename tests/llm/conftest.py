import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, kept string, n_words string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing column names."""
    body = " ".join(f"word{i}" for i in range(60))
    rows = [
        (1, body, "en", "a", 1, "x", "x", "x"),
        (1, body, "en", "a", 1, "x", "x", "x"),
        (2, body + " more", "en", "a", 1, None, None, None),
        (3, None, None, None, None, None, None, None),
        (None, "released under the MIT License now", None, "b", None, None, None, None),
        (4, "", "en", "b", 0, None, None, None),
        (5, " \n \t", "en", None, 0, None, None, None),
        (6, "mail a.b@example.org or A.B@example.org, card 4041894974608795", "en", "b", 0, "", "", ""),
        (7, "one " * 30_000, "de", "c", 120_000, None, None, None),
        (8, "début " + "\n".join(["same line here"] * 40), "fr", "c", 0, None, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
