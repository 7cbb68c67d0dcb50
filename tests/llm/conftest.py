import pytest
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture
def docs_of(spark):
    """A documents table out of (doc_id, text) pairs, with extra columns named like helpers."""

    def make(pairs):
        df = spark.createDataFrame([(i, t, None, None, None) for i, t in pairs], DOCS)
        return df.withColumns({"_id": F.lit(7), "first": F.lit("x"), "pos": F.lit(None).cast("int"), "k1": F.lit("y"),
                               "score": F.lit(1), "taken": F.lit(2), "_text": F.lit("z")})

    return make
