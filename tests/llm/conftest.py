import pytest

DOCS = "doc_id long, text string, lang string, n_chars long, node long, host string, score double, spans string, n int"
LONG = "alpha beta gamma delta epsilon zeta eta theta " * 3000


@pytest.fixture
def odd_docs(spark):
    """Missing ids and texts, empty and very long texts, repeated rows and ties, and columns
    named like those that operators make inside."""
    prose = "the quick brown fox jumps over the lazy dog and runs away from all of them today"
    rows = [
        (1, prose),
        (1, prose),
        (2, prose),
        (2, "another text under an id that has been used before, so ids are not unique here"),
        (None, prose),
        (None, None),
        (3, None),
        (4, ""),
        (5, " \n\n \t "),
        (6, LONG),
        (7, "é日本語 short"),
        (7, "é日本語 short"),
        (8, "word"),
    ]
    return spark.createDataFrame([(*r, "en", 1, 7, "h", 0.5, "s", 3) for r in rows], DOCS)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture
def docs_of(spark):
    def make(*texts):
        return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    return make
