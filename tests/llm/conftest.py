import pytest

from tests.llm.made_texts import SF


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Nulls everywhere, empty and long texts, repeated rows and ids, and columns with names used inside."""
    long = " ".join(f"w{k * k % 977}" for k in range(40_000))
    rows = [
        (1, "Plain words about a thing.\nSecond line 12 here", 5), (2, None, 1), (3, "", None), (3, "", None), (None, None, 3),
        (None, "no id here", 2), (4, long, 9), (5, long, 9), (6, "été 世界 😀 naïve façade\n\n", 0), (6, "another text under one id", 0),
        (7, "   \n\t\n ", 0), (8, "a" * 5000, 1), (9, "!!! ??? ...", 1), (10, "!!! ??? ...", 1), (11, "one two", 1),
    ]
    wide = [(*r, "x", "y", 1.0, "z", "q", 7, "p", "o", "s") for r in rows]
    names = "doc_id long, text string, n_chars long, row string, id string, score double, cut string, lines string, places int, removed string, late string, quality_score string"
    return spark.createDataFrame(wide, names)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, n_chars long")


@pytest.fixture(scope="module")
def few_docs(spark):
    """All documents of the smallest tables as a frame and as pairs."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return docs, sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
