import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Rows (doc_id, text) as a documents table."""
    def of(rows):
        return spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], SCHEMA)
    return of


@pytest.fixture(scope="session")
def clashing(spark):
    """The same with further columns whose names operators use themselves."""
    def of(rows):
        names = ["t", "m", "key", "node", "label", "s", "e", "x", "k", "h", "c", "n", "unit", "kept", "found", "start", "bands", "class_id", "first"]
        schema = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names)
        return spark.createDataFrame([(d, t, *names) for d, t in rows], schema)
    return of


EDGE_ROWS = [(1, None), (2, ""), (3, " \n\t "), (None, "a row without an id but with some words in it"), (4, "same text twice"),
             (4, "same text twice"), (5, "x"), (6, "\n\n\n"), (7, "word " * 30_000), (8, "é" * 50_000)]
