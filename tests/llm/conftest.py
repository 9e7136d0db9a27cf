import pytest

from tests.llm.helpers import prose, rows

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
@pytest.fixture(scope="session")
def documents(spark):
    """Frame from a list of texts; doc_id is the place in the list."""

    def make(texts):
        return spark.createDataFrame(rows(texts), SCHEMA)

    return make


@pytest.fixture(scope="session")
def awkward(spark):
    """NULLs in any column, empty, blank and long texts, repeated rows and ids, columns with names used inside."""
    base = rows([None, "", " \n\t ", "word", prose(1, 60), prose(1, 60), prose(2, 30_000), "x" * 5000, "a\n" * 500])
    base += [(None, prose(3, 40), None, None, None), (4, prose(4, 50), None, "s", 1), base[4], base[4]]
    extra = "row_hash int, fp string, lines string, gone string, sentence string, key string, component int, size int, h int"
    return spark.createDataFrame([(*r, *[None] * 9) for r in base], f"{SCHEMA}, {extra}")
