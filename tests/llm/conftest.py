import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from ``(doc_id, text)`` or whole rows."""

    def make(rows):
        whole = [tuple(r) if len(r) == 5 else (r[0], r[1], "en", f"src{(r[0] or 0) % 3}", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(whole, DOCS)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty, blank, short, long, repeated rows, equal texts under several ids."""
    long = " ".join(f"w{i % 997} v{i % 89}" for i in range(30_000))
    same = "one two three four five six seven eight nine ten"
    return [
        (1, None, None, None, None), (2, "", "en", "", 0), (3, "   \n \n", "en", "a", 6), (4, "word", "de", None, 4), (None, same, "en", "a", None),
        (5, same, "en", "a", len(same)), (6, same, None, "b", len(same)), (6, same, None, "b", len(same)), (7, long, "fr", "b", len(long)), (8, "123 456 !!!", "en", "a", 11),
        (None, None, None, None, None), (9, "Ünïcödé 😀 text ß", "de", "c", 16),
    ]
