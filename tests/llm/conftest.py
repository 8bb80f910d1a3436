import pytest

LONG = " ".join(f"word{i % 977} tail{i % 31}" for i in range(40_000))
WALL = "x1" * 60_000
ODD_TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog.\nShared line\nanother one"),
    (2, None),
    (3, ""),
    (4, " \t\n \n"),
    (5, LONG),
    (6, WALL),
    (7, "a"),
    (None, "no number, some words here to read"),
    (8, "  SHARED line \nsomething else entirely  "),
    (8, "  SHARED line \nsomething else entirely  "),
    (9, "été 😀 naïve ▁ \0 日本語\r\nshared LINE"),
    (10, "The quick brown fox jumps over the lazy dog.\nShared line\nanother one"),
]
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, key string, label string, score string, "
    "shard string, fp string, ids string, leaf string, node string, n_lines string, features string, word string"
)


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and very long texts, repeated rows and columns named like the operators' own."""
    rows = [(i, t, None, "src", None, *["clash"] * 11) for i, t in ODD_TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")
