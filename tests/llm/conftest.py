import pytest


@pytest.fixture
def documents(spark):
    """A DataFrame of documents from (doc_id, text) pairs, with columns whose names clash with internal ones."""

    def make(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long, cls long, label string, record string, kept int, batch string, n int, held int"
        return spark.createDataFrame([(i, t, "en", "src", None if t is None else len(t), 1, "x", "y", 2, "z", 3, 4) for i, t in rows], schema)

    return make


#: Null, empty and blank texts, ties, repeated rows, null ids, a long text.
ODD = [(None, "a b c d e f"), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two three four five six"), (5, "one two three four five six"), (6, "one two three four five six"), (7, "x " * 30000), (8, "ümläut 漢字 😀 <|endoftext|> it's")]


@pytest.fixture
def odd(documents):
    return documents(ODD)
