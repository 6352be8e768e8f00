import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


@pytest.fixture(scope="session")
def run(spark):
    """The rows of a registered query over the smallest tables."""
    from vectrine.llm.queries import QUERIES

    return lambda name: QUERIES[name](spark, FOLDER).collect()
