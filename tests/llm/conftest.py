import pytest
from pyspark.sql import types as T

from exactsync.llm.shared import prepare

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def docs(spark):
    """Make a documents table from (doc_id, text[, lang[, source]]) rows, with extra columns of awkward names."""
    prepare(spark)

    def make(rows):
        full = [(*r, *([None] * (4 - len(r))), None if r[1] is None else len(r[1])) for r in rows]
        from pyspark.sql import functions as F

        df = spark.createDataFrame(full, DOCUMENT)
        return df.withColumns(
            {name: F.lit("x") for name in ("id", "size", "lane", "row", "key", "h1", "word", "kept", "a.b", "base", "node")}
        )

    return make
