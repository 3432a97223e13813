import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"

# Columns of documents; the extra ones carry names that operators use inside.
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A documents table of the given texts, with ids from 1 unless they are given."""

    def build(texts, ids=None, langs=None):
        rows = [
            (ids[i] if ids else i + 1, t, langs[i] if langs else "en", f"src{i % 3}", None if t is None else len(t))
            for i, t in enumerate(texts)
        ]
        return spark.createDataFrame(rows, DOCUMENTS).repartition(3)

    return build


@pytest.fixture(scope="session")
def small_documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
