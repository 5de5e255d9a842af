import pytest


@pytest.fixture
def rows_of(spark):
    """Documents from ``(doc_id, text)`` pairs, with columns that operators must not trip over."""
    def make(pairs, extra=True):
        docs = spark.createDataFrame(list(pairs), "doc_id long, text string")
        if extra:
            names = ("key", "n_words", "component_id", "size", "score", "pos", "h1", "fp", "label", "row_no")
            docs = docs.selectExpr("*", *[f"'x' AS {n}" for n in names])
        return docs
    return make
