import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with columns whose names the operators use themselves."""

    def make(pairs):
        rows = [(i, t, "en", "src0", len(t or "")) for i, t in pairs]
        docs = spark.createDataFrame(rows, SCHEMA)
        for name in ("fp", "bucket", "words", "score", "key", "root", "text_key", "packed"):
            docs = docs.selectExpr("*", f"'x' AS {name}")
        return docs

    return make


@pytest.fixture(scope="session")
def odd_pairs():
    """Null id, null and empty text, repeated rows, equal texts, a long text, odd characters."""
    words = [f"word{i % 997}" for i in range(30_000)]
    long = " ".join(words)
    return [
        (1, "the quick brown fox jumps over the lazy dog"),
        (1, "the quick brown fox jumps over the lazy dog"),
        (2, "the quick brown fox jumps over the lazy dog"),
        (3, None), (4, ""), (5, " \t\n "), (None, "no id here at all"), (None, None),
        (6, long), (7, "Éa b c \x1cd \U0001f600 MIT License."), (8, "single"),
    ]
