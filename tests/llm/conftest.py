import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()


def prose(n, seed=0):
    """n words that repeat no window of three too often."""
    return " ".join(f"{WORDS[(i * i + seed * 7 + i // 5) % 12]}{(i * 31 + seed) % 97}" for i in range(n))


ODD = [
    (1, None, "en", "a", 0),
    (2, "", "en", "a", 0),
    (3, " \t\n\x0b ", None, None, 4),
    (4, "one", "en", "b", 3),
    (5, prose(60, 1), "en", "a", None),
    (5, prose(60, 1), "en", "a", None),
    (6, prose(60, 1), "de", None, 1),
    (None, prose(60, 2), "de", "c", 1),
    (None, None, None, None, None),
    (7, prose(30000, 3), "fr", "b", 1),
    (8, "x" * 30000, "fr", "b", 1),
    (9, "éß \U0001f642 日本 \x00 <|endoftext|>", "fr", "c", 1),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids."""
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
