import pytest

ODD_TEXTS = [None, "", " ", "\n\n", "one", "one two three four", "A a A a A a", "éÉ 日本語 \U0001f642",
             "x" * 5000, "word " * 3000, "tab\tsep\x0bline\x0cform\r\nend"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null and repeated ids, odd texts, and extra columns with names that operators use themselves."""
    rows = [(i, t, "c", 1, "k") for i, t in enumerate(ODD_TEXTS)] + [(None, "no id here at all today", "c", 1, "k"), (3, "one two three four", "c", 1, "k"), (4, "one", "c", 1, "k"), (4, "one", "c", 1, "k")]
    return spark.createDataFrame(rows, "doc_id long, text string, node string, n int, label string")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, node string, n int, label string")


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
