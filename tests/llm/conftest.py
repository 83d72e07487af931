import pytest

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def shipped(spark):
    from lakemart.llm.common import ship_package
    ship_package(spark)
    return spark


@pytest.fixture(scope="session")
def odd_documents(shipped):
    """Nulls in every column, empty, blank and very long texts, repeated rows, and a column of an operator's own name."""
    word = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do"
    rows = [(1, None, None, None, None), (2, "", "en", "", 0), (3, " \t\n\x0b\x0c\r ", "en", "a", 7),
            (4, "one", "en", "a", 3), (5, "one two", "en", "b", 7), (6, "One  TWO", "en", None, 8),
            (7, " ".join(f"{w}{i}" for i in range(2500) for w in word.split()), "en", "a", 1),
            (8, "x" * 100_000, "de", "b", 100_000), (9, "same text here again", "fr", "b", 20),
            (9, "same text here again", "fr", "b", 20), (10, "same text here again", "fr", "a", 20),
            (None, "same text here again", None, "c", 20), (None, None, None, None, None),
            (11, "été ß 日本語 <|endoftext|> don't", "fr", "c", 30)]
    return shipped.createDataFrame([(*r, 5.0) for r in rows], DOCS + ", size double").repartition(3)


@pytest.fixture(scope="session")
def no_documents(shipped):
    return shipped.createDataFrame([], DOCS + ", size double")
