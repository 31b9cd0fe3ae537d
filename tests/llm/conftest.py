import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("shard", T.StringType())])


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows and a clashing extra column."""
    long = " ".join(f"w{i}" for i in range(6000))
    rows = [(1, "a b c d e f g h", "en", "s", 5, "x"), (1, "a b c d e f g h", "en", "s", 5, "x"), (2, None, None, None, None, None),
            (3, "", "en", None, 0, "y"), (None, "A b c d e f g h", None, "s", 1, None), (4, long, "de", "t", 9, "z"),
            (5, long + " tail", "de", "t", 9, "z"), (6, "mail ann.lee@mail.example.com or +1 (017) 555-7713 é", "fr", "t", 9, "z"),
            (7, "\x1c odd <|endoftext|>   it's 10.0.0.1\n\n x", "fr", "t", 9, "z")]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
