import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, _t string, _row string, key long, "
          "score double, label string, _language string, h string")


@pytest.fixture(scope="session")
def make_docs(spark):
    """(doc_id, text, lang) rows as documents with extra columns whose names the operators use inside."""
    def make(rows):
        full = [(i, t, lang, "src0", len(t or ""), "x", "y", 7, 0.5, "z", None, "w") for i, t, lang in rows]
        return spark.createDataFrame(full, SCHEMA)
    return make


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in each column, empty and very long texts, repeated rows, ties, odd characters."""
    prose = "The people of the town went to the market in the morning and it was a good day for all of them. " * 8
    return [(1, prose, "en"), (1, prose, "en"), (2, prose, None), (None, prose + "More words.", "en"), (None, None, None), (3, None, "en"),
            (4, "", "fr"), (5, " \n\t ", "de"), (6, "\n\n", None), (7, "a", "en"), (8, "12 34 !!", "es"),
            (9, "word " * 60_000, "en"), (10, "x" * 200_000, "de"), (11, "日本語 テキスト   ΣΑΣ İK \x1c <|endoftext|>  a   b", "fr")]


@pytest.fixture(scope="session")
def empty_docs(make_docs):
    return make_docs([]).limit(0)
