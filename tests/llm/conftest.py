import pytest


@pytest.fixture
def docs_of(spark):
    """A documents table from texts (or rows), with columns whose names an operator might use itself."""
    from pyspark.sql import functions as F

    def run(rows, schema="doc_id long, text string, lang string, source string"):
        rows = [r if isinstance(r, tuple) else (i, r, "en", "s") for i, r in enumerate(rows)]
        df = spark.createDataFrame(rows, schema)
        for c in ("salt", "digest", "fp", "part", "bucket", "row", "norm", "key", "size", "start", "term", "doc", "n", "x", "label", "token"):
            df = df.withColumn(c, F.lit("clash"))
        return df

    return run


EDGE = [None, "", " \n\t", "a", "the same text here", "the same text here", "x" * 50_000, "word " * 30_000, "日本語 текст é", "a"]


@pytest.fixture
def edge():
    return list(EDGE)
