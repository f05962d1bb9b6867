import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture
def tables(spark, tmp_path):
    """Writes tables, from rows and a schema, to a folder that a query can read."""

    def write(**given):
        for name, (rows, schema) in given.items():
            spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return write


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {row.doc_id: row.text for row in documents.select("doc_id", "text").collect()}
