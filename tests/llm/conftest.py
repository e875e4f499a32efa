import pytest


@pytest.fixture(autouse=True)
def small_batches(spark):
    """Groups go over the seams of Arrow batches in every test."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
