import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def mixed(spark):
    """The small documents table and the awkward rows, as rows and as a table."""
    from brute import SCHEMA, awkward, frame

    given = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    rows = [(r.doc_id + 1000, r.text, r.lang, r.source, r.n_chars, "k", "c", "y", "w") for r in given] + awkward()
    return rows, frame(spark, rows), spark.createDataFrame([], SCHEMA)
