import pytest


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with every awkward case, and columns whose names clash with those inside the operators."""
    long = " ".join(f"word{i % 997} some" for i in range(30_000))
    texts = [None, "", "   ", "\n\n", "one", "one two", "Äpfel ÉTÉ straße 水 🙂", long, "same text here again and again"]
    rows = [(i, t, "en", "s", 1, 2, "x", 3.0, 4, True, "y") for i, t in enumerate(texts)]
    rows += [(8, texts[8], "en", "s", 1, 2, "x", 3.0, 4, True, "y")] * 2  # repeated rows
    rows += [(None, "a text without an id, of several words in a line", None, None, None, None, None, None, None, None, None)] * 2
    rows += [(20, "a text without an id, of several words in a line", "de", None, 1, 2, "x", 3.0, 4, True, "y")]
    columns = "doc_id long, text string, lang string, source string, name int, block int, word string, score double, id int, kept boolean, removed string"
    return spark.createDataFrame(rows, columns)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
