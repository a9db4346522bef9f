import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType())])


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (id, text) or (id, text, source) rows, with extra columns that clash with added ones."""

    def build(rows, *extra):
        df = spark.createDataFrame([(*r, None) if len(r) == 2 else tuple(r) for r in rows], DOCS)
        for c in extra:
            df = df.selectExpr("*", f"'x' AS `{c}`")
        return df

    return build
