import pytest
from pyspark.sql import functions as F

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, size string, label int"


@pytest.fixture(scope="session")
def documents(spark):
    """Make documents with columns whose names the operators use inside; doc_id, text and perhaps more are given."""

    def make(rows):
        full = [(*row, *(None,) * (5 - len(row)), "clash", 7) for row in rows]
        return spark.createDataFrame(full, DOCUMENTS).withColumn("key", F.lit("k")).withColumn("sketch", F.lit(1))

    return make


@pytest.fixture(scope="session")
def rows():
    return lambda frame: sorted((tuple(r) for r in frame.collect()), key=repr)
