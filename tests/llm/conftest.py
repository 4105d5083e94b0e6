import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"

#: Nulls in every column, empty and blank texts, a repeated row, ties, a long text.
ODD = [
    (1, "a b c d e f", "en", "s1", 11), (1, "a b c d e f", "en", "s1", 11), (2, None, "en", "s1", None), (3, "", None, None, 0),
    (None, "one two three four", None, "s2", 3), (None, None, None, None, None), (4, " \t\n ", "en", "s1", 4),
    (5, "word " * 30000, "en", "s2", 150000), (6, "x" * 60000, "en", "s2", 60000), (7, "é𝄞 ñandú \x00 z", "fr", "s3", 9),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(odd):
    """Extra columns named like columns that operators make."""
    from pyspark.sql import functions as F
    out = odd
    for name in ("size", "spans", "score", "ids", "n", "node", "label", "taken", "_src", "_key", "h", "k1", "row", "path", "decoded"):
        out = out.withColumn(name, F.lit("extra"))
    return out
