"""Documents with every awkward case, for all operators."""

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "id long, key string, size int, component long, gone_id int, times long, found_lang string, score double"
)
LONG = " ".join(f"word{i % 977} tail{i}" for i in range(60_000))


def awkward_rows():
    texts = [
        (1, "The quick brown fox jumps over the lazy dog and runs away.", "en", "a"),
        (2, "The quick  brown\tfox jumps over the lazy dog and runs away.", "en", "a"),
        (3, None, "en", "a"),
        (4, "", None, "b"),
        (5, "   \n\t ", "de", None),
        (6, "Der schnelle braune Fuchs springt über den faulen Hund und läuft.", "de", "b"),
        (6, "Der schnelle braune Fuchs springt über den faulen Hund und läuft.", "de", "b"),
        (7, LONG, "en", "c"),
        (8, "123 456 !!! ???", "en", "c"),
        (None, "A text without an id but with words in it.", "en", "a"),
        (None, None, None, None),
        (9, "x<|endoftext|>y 中文 😀 \U0001f9ff͸ it's we'll 'sabc", "en", "d"),
        (10, LONG, "en", "c"),
        (11, "one line\n\none line\nanother line of words here\nANOTHER  line of words here", "en", "a"),
    ]
    return [(i, t, lang, s, None if t is None else len(t), 5, "k", 1, 2, 3, 4, "zz", 0.5) for i, t, lang, s in texts]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").cache()


@pytest.fixture(scope="session")
def documents(small):
    return {r["doc_id"]: r for r in small.collect()}
