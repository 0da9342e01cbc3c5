import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use themselves
    T.StructField("size", T.StringType()), T.StructField("score", T.StringType()), T.StructField("_key", T.StringType()),
    T.StructField("fingerprint", T.StringType()), T.StructField("_row", T.StringType()), T.StructField("shard", T.StringType()),
])

BASE = " ".join(f"w{i % 37}x{i % 11}" for i in range(120))


def rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    long = " ".join(f"t{i % 997}y{i % 13}" for i in range(60_000))
    texts = [
        (1, BASE), (2, BASE), (3, BASE.upper()), (4, BASE + " tail"), (5, ""), (6, None), (7, "   \n\t "), (8, "one"),
        (9, "two words"), (10, long), (11, long + " end"), (12, "ümlaut ünd mehr ß"), (12, "ümlaut ünd mehr ß"),
        (13, "same id, one text"), (13, "same id, another text"), (None, "no id here"), (None, None), (None, BASE),
        (14, "a\u0000b zero byte"), (15, "x" * 5000), (16, "x" * 5001),
    ]
    return [(i, t, "en" if i else None, None if k % 4 == 0 else f"src{k % 3}", None if t is None else len(t),
             "9", "s", "k", "f", "r", "h") for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def labels(spark):
    table = [(i, 1 if i % 3 else 0, 1 if i % 2 else 0) for i in range(1, 17)] + [
        (None, 1, 1), (3, None, None), (4, 0, 0), (4, 1, 1), (99, 1, 0)]
    return spark.createDataFrame(table, "doc_id long, quality int, toxic int")
