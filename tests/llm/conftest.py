import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use inside
    T.StructField("key", T.StringType()), T.StructField("length", T.StringType()), T.StructField("words", T.StringType())])


@pytest.fixture
def docs(spark):
    def make(*rows):
        """Documents from (doc_id, text) with other columns null or clashing."""
        return spark.createDataFrame([(d, t, None, None, None, "k", "l", "w") for d, t in rows], DOCS).repartition(3)
    return make


@pytest.fixture
def odd(docs):
    """Nulls, empty and long texts, ties and repeated rows."""
    words = " ".join(f"word{k}" for k in range(40))
    return docs((1, words + " tail one"), (2, "head " + words), (3, None), (4, ""), (5, words + " tail one"), (5, words + " tail one"),
                (None, "alone ünd " + words), (7, "x " * 6000), (8, "# a\n# a\nb\n\n  c"), (None, None))
