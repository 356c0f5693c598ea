"""What the operator tests share; the session comes from ``tests/conftest.py``."""

import pytest

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def docs(spark):
    """Rows (doc_id, text) with an extra column whose name an operator also uses."""
    from pyspark.sql import functions as F

    def make(rows, extra="score"):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        return df.withColumn("source", F.lit("s")).withColumn(extra, F.lit("extra"))

    return make
