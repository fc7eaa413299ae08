import os

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"

#: Texts that every operator must take: null, empty, white space, one word, odd characters, long.
ODD_TEXTS = [None, "", " \t\n\x0b\x0c\r ", "x", "é", "Ÿ ẞ \x00 ΑΣ İ", "a\n\na\n", "ᬅ́ \U0001F600" * 3,
             "word " * 30_000, "x" * 50_000]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Odd texts, each twice, with a null id, a repeated row and columns named like an operator's own."""
    data = [(i, t) for i, t in enumerate(ODD_TEXTS * 2)] + [(None, "no id"), (3, "x"), (3, "x")]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, n_words string"
    return spark.createDataFrame([(i, t, None, "s", None, "own", "own") for i, t in data], schema)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small_dir():
    if not os.path.isdir(SMALL):
        pytest.skip("the small tables are not here")
    return SMALL
