import pytest

#: Edge cases of a documents table: nulls in every column, empty and very long texts, texts
#: without words, equal ids, repeated rows.  Column names that the operators use themselves.
LONG = " ".join(f"word{i % 977} thing{i % 31}" for i in range(12_000))
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog and runs away home", "en", "a", 3),
    (1, "the quick brown fox jumps over the lazy dog and runs away home", "en", "a", 3),
    (2, "The Quick brown fox jumps over the lazy dog and runs away home", "en", None, None),
    (2, "another text under the id two", None, "b", 1),
    (3, None, "en", "b", None),
    (4, "", "en", "b", 0),
    (5, " \t\n ", "fr", "a", 3),
    (6, LONG, "en", "a", None),
    (7, LONG, "en", "c", 9),
    (8, "idiot", "en", "c", 5),
    (9, "tiny text", None, None, 9),
    (None, "a row without an id but with several words in it", "en", "a", 1),
    (None, None, None, None, None),
    (2**60 + 1, "é ö ñ — ünïcode “quotes” 日本語 😀 ok", "xx", "d", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame([(*r, i, "x") for i, r in enumerate(ROWS)], SCHEMA + ", score int, shard string")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, i % 2, (i + 1) % 2) for i in range(1, 10)] + [(None, 1, 1), (1, None, None), (4, 0, 0), (4, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
