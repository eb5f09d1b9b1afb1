import pytest

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                       # columns whose names the operators use inside
                       T.StructField("node", T.StringType()), T.StructField("key", T.IntegerType()), T.StructField("bucket", T.IntegerType())])


@pytest.fixture(scope="session")
def documents(spark):
    """A frame of (doc_id, text) rows with all columns of documents and some with clashing names."""
    def make(rows, lang="en"):
        return spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t), "x", 1, 2) for i, t in rows], SCHEMA).repartition(3)
    return make
