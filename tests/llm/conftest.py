import pytest
from pyspark.sql import types as T

LONG = "long words of one text " * 20_000

#: doc_id, text, lang, source, and columns whose names the operators use inside.
EDGE = [
    (1, "The same text", "en", "a", 1, "x"), (2, "the SAME text", "en", "a", 2, "x"),
    (3, None, "en", "b", 3, None), (4, "", None, "b", 4, "y"), (5, LONG, "de", None, None, "z"),
    (6, "Ähnlich ähnlich", "de", "c", 5, "x"), (6, "Ähnlich ähnlich", "de", "c", 5, "x"),
    (7, "  two  spaces \n\n and lines \t", "en", "c", 6, "x"), (8, "word", "en", "d", 7, "x"),
    (None, "no number", "en", "d", 8, "x"), (None, None, None, None, None, None),
    (9, "<|endoftext|> is text | # $$$ %%%", "en", "c", 9, "x"),
]
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("size", T.LongType()), T.StructField("run", T.StringType())])


@pytest.fixture
def edge(spark):
    return spark.createDataFrame(EDGE, SCHEMA).repartition(3)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
