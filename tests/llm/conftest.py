import pytest

from tests.conftest import SF001, spark  # noqa: F401


@pytest.fixture(scope="session")
def sf():
    return SF001


ODD_TEXTS = [(1, "one two three four five six seven"), (1, "one two three four five six seven"), (2, None), (3, ""), (None, "null id here"),
             (None, "null id here"), (4, " \t\n "), (5, "word " * 30000), (6, "é ü ß ñ 日本語 <|endoftext|> x"), (7, "one two three four five six seven"),
             (7, "another text under the same id"), (8, "a"), (9, "A\x00b \x85c\x1cd")]


@pytest.fixture(scope="session")
def odd_docs(spark):  # noqa: F811
    """Nulls, empties, repeats, a very long text and columns named like results."""
    rows = [(i, t, "en", "s" if k % 3 else None, len(t or ""), 1.5, True, k) for k, (i, t) in enumerate(ODD_TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, n_words int")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
