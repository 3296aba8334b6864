import pytest

from riskloom.llm.shipping import prepare

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, keep string, row string, k string"


@pytest.fixture(scope="session", autouse=True)
def prepared(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents with columns whose names the operators use themselves."""

    def make(rows):
        full = [(i, t, "en", s, None if t is None else len(t), "keep", "row", "k") for i, t, s in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


LONG = "Many words in a row. " * 20_000


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty, blank and very long texts, ties, repeated rows."""
    return [
        (1, "The quick brown fox\njumps over", "a"), (2, "the QUICK brown fox\njumps over", "a"), (3, None, "a"),
        (4, "", None), (5, " \t\n\x0b", "b"), (6, LONG, "b"), (7, "Übung ▁ macht 漢字 \U0001f389", "b"),
        (None, "no key", "a"), (8, "same row", None), (8, "same row", None), (9, "one", "c"), (10, LONG, "a"),
    ]
