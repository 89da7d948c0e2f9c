import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """A table of documents from (doc_id, text) or (doc_id, text, source) rows."""

    def make(*rows):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)

    return make


@pytest.fixture(scope="session")
def odd(docs):
    """Null and empty texts, no id, white space only, repeated rows, one long word, a long text."""
    long = " ".join(f"w{i % 5000}" for i in range(60_000))
    return docs((0, None), (1, ""), (2, " \t\n"), (None, "some text without an id here"), (3, "one two"), (3, "one two"), (4, "x" * 200_000), (5, long), (6, "naïve café ßtraße \U0001f600 fin"), (7, "one two", None))
