import pytest
from pyspark.sql import functions as F

LONG = "alpha beta gamma " * 4_000


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, clashing names."""
    rows = [
        (1, "a b c d e f\nsecond line here\nthird line here\nfourth", "en", "s1", 5),
        (2, "a b c d e f\nsecond line here\nthird line here\nfourth", "en", "s1", 5),
        (3, None, None, None, None),
        (4, "", "en", "s2", 0),
        (5, " \n\t ", "de", None, 4),
        (6, LONG, "en", "s1", len(LONG)),
        (7, "mail x.y@z.example and +1 (555) 010-9999", "de", "s2", 40),
        (7, "mail x.y@z.example and +1 (555) 010-9999", "de", "s2", 40),
        (None, "no id here at all, only words", "fr", "s3", 29),
        (8, "Ünïcode 日本語 text", "fr", "s3", 16),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.withColumn("id", F.lit(1)).withColumn("hash", F.lit("x")).withColumn("n", F.lit(2)).withColumn("row", F.lit(0))


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)
