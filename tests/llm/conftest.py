import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "lorem ipsum dolor sit amet " * 40_000  # a million bytes

#: Every case at once: nulls in each column, empty and blank texts, a very long one, ties,
#: repeated rows, repeated ids with different texts.
NASTY = [
    (1, "the quick brown fox jumps over the lazy dog today", "en", "a", 49),
    (1, "the quick brown fox jumps over the lazy dog today", "en", "a", 49),
    (2, None, "en", "a", None),
    (3, "", "en", None, 0),
    (4, " \t\n", None, "b", 3),
    (None, "der schnelle braune Fuchs springt über den faulen Hund", "de", "b", 54),
    (None, None, None, None, None),
    (5, "der schnelle braune Fuchs springt über den faulen Hund", None, "b", 54),
    (6, LONG, "la", "b", len(LONG)),
    (7, "12345 67890 !!! ???", "en", "b", 19),
    (7, "another text under the same id as before it", "en", "c", 43),
    (8, "naïve café 東京 🙂 I'm", "fr", "c", 20),
]


@pytest.fixture(scope="session")
def nasty(spark):
    return spark.createDataFrame(NASTY, DOCUMENTS).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture
def docs(spark):
    """Documents from texts, with ids from 0."""

    def make(texts, **columns):
        rows = [
            (i, t, columns.get("lang", ["en"] * len(texts))[i], columns.get("source", ["s"] * len(texts))[i], 0)
            for i, t in enumerate(texts)
        ]
        return spark.createDataFrame(rows, DOCUMENTS).repartition(3)

    return make


def small(name):
    return f"/root/testdata/sf0.001/{name}.parquet"


@pytest.fixture(scope="session")
def real(spark):
    """The documents of the smallest tables."""
    return spark.read.parquet(small("documents"))
