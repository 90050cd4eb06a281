import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    """Builds a documents table from (doc_id, text) rows, with a column whose name clashes with helpers."""

    def build(rows):
        return spark.createDataFrame(
            [(i, t, None, "s", None if t is None else len(t), "extra") for i, t in rows],
            "doc_id long, text string, lang string, source string, n_chars long, row string",
        ).repartition(3)

    return build


@pytest.fixture(scope="session")
def sample(spark):
    """(doc_id, text) of the smallest sample table."""
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
