import pytest
from pyspark.sql import types as T

from tagmill.llm.common import ready

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("token", T.StringType()),
                     T.StructField("size", T.StringType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents of (id, text) pairs, with extra columns whose names operators use inside."""
    ready(spark)

    def make(rows, lang="en", source="s"):
        return spark.createDataFrame([(i, t, lang, source, len(t or ""), "x", "y") for i, t in rows], DOCS)

    return make


EDGES = [(1, None), (2, ""), (3, "   \n\n "), (4, "one"), (5, "one two three four five six"), (5, "one two three four five six"),
         (None, "no id here at all"), (7, "Ünïcödé wörds 漢字 🙂 #tag\nline\nline"), (8, "word " * 30_000)]


@pytest.fixture(scope="session")
def edges(docs_of):
    return docs_of(EDGES)
