import os

import pytest

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="session")
def awkward(spark):
    """Null, empty, blank, tiny and long texts, repeated rows, null keys, and columns named like inner ones."""
    base = "the quick brown fox jumps over the lazy dog while seven wizards watch from the old stone tower"
    long = " ".join(f"word{i % 9973}" for i in range(60_000))
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, None), (4, "Word", "en", "b"), (5, base, "en", "a"),
        (5, base, "en", "a"), (6, base.upper(), "en", "b"), (7, base + " again", "en", None), (None, base, "en", "c"),
        (None, None, None, None), (8, long, "en", "c"), (9, "x" * 100_000, "en", "c"), (10, "été çà ß Ñandú 日本語", "fr", "é"),
        (11, "one\n\n\ntwo\n" + base, "en", "b"), (12, base + "\n" + base, "en", "z"), (-3, "12345 67890 !!! ???", "en", "z"),
    ]
    wide = [(*r, None if r[1] is None else len(r[1]), "s", 1, "t", 2.0, "k", [1]) for r in rows]
    extra = "size string, n int, tie string, score double, key string, keys array<int>"
    return spark.createDataFrame(wide, f"{DOCS}, {extra}").cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(5, 1, 0), (5, 0, 1), (6, None, None), (None, 1, 1), (99, 1, 1), (7, 0, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
