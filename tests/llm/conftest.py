import pytest

#: Column names that operators use inside; as extra columns they must not matter.
CLASHES = ("key", "text_hash", "host", "fp", "n", "rows", "ids", "kind", "score", "lang_pred", "start", "part", "gone",
           "component_id", "words", "line", "capacity", "copies", "more", "spans")
DOC = "doc_id long, text string, lang string, source string, n_chars long"
PAGE = "page_id long, url string, html string"

PASSAGE = " ".join(f"shared{i}" for i in range(60))
LONG = " ".join(f"w{i % 977} the" for i in range(60_000))


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows, clashes=False):
        full = [(i, t, lang, src, None if t is None else len(t)) for i, t, lang, src in rows]
        df = spark.createDataFrame(full, DOC)
        if clashes:
            from pyspark.sql import functions as F

            df = df.withColumns({c: F.lit(f"extra {c}") for c in CLASHES})
        return df

    return make


@pytest.fixture(scope="session")
def awkward(make_docs):
    """Nulls in any column, empty and very long texts, repeated rows, equal ids, names that clash."""
    rows = [
        (1, "The cat sat on the mat and the dog was with a bone. " * 4, "en", "s1"),
        (2, "", "en", "s1"),
        (3, None, None, None),
        (None, "der hund und die katze", "de", None),
        (None, None, None, "s2"),
        (4, LONG, "en", "s2"),
        (5, "same text, same id 12", "en", "s1"),
        (5, "same text, same id 12", "en", "s1"),
        (5, "same id, other text", "en", "s1"),
        (6, "\n\n \t\n", "fr", "s3"),
        (7, "über straße 😀 漢字 x", "de", "s3"),
        (8, f"head\n{PASSAGE}\ntail one", "en", "s1"),
        (9, f"start\n{PASSAGE}\ntail two", None, "s1"),
    ]
    return make_docs(rows, clashes=True)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], DOC)
