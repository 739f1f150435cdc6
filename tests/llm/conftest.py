import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """DataFrame of documents from (doc_id, text, source) rows, with a column that clashes with inner names."""

    def make(rows, extra="ids long, score string"):
        rows = [(i, t, "en", s, None if t is None else len(t), 1, "x") for i, t, s in rows]
        return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {extra}")

    return make


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


ODD = [
    (1, None, "a"), (2, "", "a"), (2, "", "a"), (3, "one two", None), (4, "x" * 30_000, "b"), (5, "word " * 8_000, "b"), (None, "no id here at all today", "c"),
    (6, "same text in two rows of one id", "c"), (6, "same text in two rows of one id", "c"), (7, "  é 日本 \u0000 <|endoftext|>\n\n tab\t", "d"),
]


@pytest.fixture(scope="session")
def odd(frame):
    return frame(ODD)


@pytest.fixture(scope="session")
def empty(frame):
    return frame([])
