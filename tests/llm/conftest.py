import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, kept string, size string, target string, ids string, rank string, label string, sig string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text, lang, source), with further columns whose names clash with those that operators add or use."""

    def make(rows):
        return spark.createDataFrame([(i, t, lang, source, None if t is None else len(t), "s", "k", "9", "t", "i", "r", "l", "x") for i, t, lang, source in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Null ids, texts and keys, empty and blank texts, one very long text, one unbroken run, ties and repeated rows."""
    words = [f"w{i % 977}" for i in range(60_000)]
    return [
        (1, "the quick brown fox jumps over the lazy dog", "en", "a"), (2, "The QUICK brown fox jumps over the lazy dog", "en", "a"),
        (3, None, "en", None), (4, "", None, "a"), (5, " \t\n ", "fr", "b"), (None, "no id here at all my friend", "en", "b"), (None, None, None, None),
        (6, " ".join(words), "de", "b"), (7, "x" * 30_000, "de", "c"), (8, "same row twice", "en", "c"), (8, "same row twice", "en", "c"),
        (9, "All rights reserved. CC-BY\nAll rights reserved. CC-BY", "fr", "\U0001F600"), (10, "12 34 !!", "fr", "a"), (11, "one", "es", "c"), (12, "éléphant été ÉTÉ", "fr", "c"),
    ]
