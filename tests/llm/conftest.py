"""Tables of the tests: small, and full of what real tables hold by accident."""

import pytest

SF = "/root/testdata/sf0.001"

DOCS = "doc_id long, text string, lang string, source string, n_chars long, __row string, fp string, slot int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Absent ids, texts and sources, empty and long texts, repeated rows and ids, columns of clashing names."""
    long_text = "alpha beta gamma delta " * 3000 + "end"
    rows = [
        (1, "one two three four five six seven eight nine ten eleven", "en", "a", 3, "x", "y", 7),
        (1, "one two three four five six seven eight nine ten eleven", "en", "a", 3, "x", "y", 7),
        (1, "another text under the same id as the first one of all", "en", "a", 3, None, None, None),
        (2, "", "en", "a", 0, "x", "y", 7), (3, None, None, None, None, None, None, None),
        (None, "no id here but words enough to be kept by any of the rules", "en", "b", 3, "x", "y", 7),
        (None, None, None, None, None, None, None, None),
        (4, long_text, "en", "b", len(long_text), "x", "y", 7),
        (5, "x" * 50_000, "en", "b", 50_000, "x", "y", 7),
        (6, "ünï çödé \U0001F600 wörds ünd më@bücher.example.org mail a@b.example.com", "de", "", 3, "x", "y", 7),
        (7, " \t\n ", "en", "c", 4, "x", "y", 7),
        (8, "one two three four five six seven eight nine ten eleven", "en", "c", 3, "x", "y", 7),
        (9, "# # # # # # # # # # # # #", "en", "c", 3, "x", "y", 7),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
