"""Small tables for the text operators."""

import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text), with columns whose names clash with those that operators make."""

    def make(rows, partitions=3):
        data = [(i, t, "x", 1, "src0") for i, t in rows]
        schema = "doc_id long, text string, kept string, count int, source string"
        return spark.createDataFrame(data, schema).repartition(partitions)

    return make
