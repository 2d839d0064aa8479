"""Small messy tables: null ids and texts, repeated rows, clashing extra columns, empty tables."""

import pytest

EXTRA = "doc_id long, text string, lang string, source string, n_chars long, h long, start long, score double, `a b` string"


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows):
        """DataFrame of (doc_id, text) rows with further columns of clashing names."""
        return spark.createDataFrame([(i, t, "en", "s", None, 7, 8, 0.5, "x") for i, t in rows], EXTRA)

    return make


MESSY = [(1, None), (2, ""), (3, " \t\n"), (None, "a text without an id here"), (4, "a b c d e f"), (4, "a b c d e f"),
         (5, "x" * 5000), (6, "é ü ñ – 漢字 \U0001f600 <s> <|endoftext|> \x00 end")]


@pytest.fixture(scope="session")
def messy(docs_of):
    return docs_of(MESSY)
