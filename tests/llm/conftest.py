import datetime

import pytest

TEXTS = [
    None,
    "",
    " \n\t ",
    "one",
    "one two",
    "the quick brown fox jumps over the lazy dog again and again",
    "the quick brown fox jumps over the lazy dog again and again",
    "Schöne Grüße aus Köln: naïve café, 日本語 テスト 😀!",
    "word " * 30_000,
    "x" * 200_000,
    "line one of it\n" * 400,
    "***!! | ### $$$",
    " " * 1_000_000,
    "some words" + " \n\t" * 300_000 + "and the last",
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, repeated rows and ids, and extra columns with clashing names."""
    day = datetime.date(2020, 1, 1)
    rows = [(i, t, "en", None if i % 3 else "src", len(t or ""), i, "a", day) for i, t in enumerate(TEXTS)]
    rows += [rows[5], rows[7], (5, "another text under a known id", None, None, None, 1, "b", None)]
    rows += [(None, "a text without an id that says a few words", "en", "s", 3, 2, "c", day), (None,) * 8]
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long, n_words long, "
        "component_id string, block date"
    )
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


@pytest.fixture(scope="session")
def odd_labels(spark):
    rows = [(i, i % 2, 0) for i in range(12)] + [(3, 0, 0), (4, None, 1), (None, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
