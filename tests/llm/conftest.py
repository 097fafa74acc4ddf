import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, doc string, `_row` int, band string, start int, kept string, score string, bucket string"


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls everywhere, empty and very long texts, ties, repeated rows, clashing extra columns."""
    long = "one two three four five six seven " * 20_000
    plain = "A plain sentence of some words stands here and says nothing.\nAnother line follows it with more of the same plain words."
    texts = [(1, None), (2, ""), (3, " \n\t "), (4, long), (5, plain), (5, plain), (6, plain), (None, plain), (None, None), (7, "word"), (8, "é ü #$%"), (9, "퟿\U0001f600 smile \U0001f600")]
    rows = [(i, t, None if k % 3 == 0 else "en", None if k % 4 == 0 else "s", None, "w", "d", 7, "b", 1, "k", "s", None) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
