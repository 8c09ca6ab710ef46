import pytest
from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("length", T.StringType()), T.StructField("score", T.StringType()),
                    T.StructField("segment", T.StringType())])


@pytest.fixture
def documents(spark):
    """A table of (doc_id, text) with extra columns named like internal ones."""
    def make(rows):
        return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], DOC)
    return make


@pytest.fixture(scope="session")
def sample(sf0001):
    import pyarrow.parquet as pq
    t = pq.read_table(f"{sf0001}/documents.parquet", columns=["doc_id", "text"])
    return list(zip(t.column(0).to_pylist(), t.column(1).to_pylist()))
