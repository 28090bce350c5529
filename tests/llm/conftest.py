import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from samples import TEXTS

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use themselves
        T.StructField("score", T.DoubleType()),
        T.StructField("n_words", T.StringType()),
        T.StructField("_at", T.LongType()),
        T.StructField("size", T.StringType()),
        T.StructField("_row", T.LongType()),
        T.StructField("fp", T.LongType()),
        T.StructField("ids", T.ArrayType(T.LongType())),
    ]
)

@pytest.fixture(scope="session")
def rows():
    """Nulls, empty and long texts, equal ids, repeated rows, and columns with clashing names."""
    out = [
        (i, t, "en", None if i % 7 == 3 else f"s{i % 3}", len(t or ""), 0.5, "w", 1, "big", 2, 3, [4])
        for i, t in enumerate(TEXTS)
    ]
    out += [out[20], out[20], out[21]]  # repeated rows
    out += [(5, "another text with an id that occurs twice in this table", *out[5][2:])]
    out += [(None, "a text without an id and some more words", *out[5][2:]), (None, None, None, None, *[None] * 8)]
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3, F.col("text")).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def sf(spark):
    return "/root/testdata/sf0.001"
