import os
from pathlib import Path

import pytest

#: Workers import the library from here, wherever the tests are started.
os.environ["PYTHONPATH"] = f"{Path(__file__).resolve().parents[2]}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture
def documents(spark):
    """(doc_id, text) rows with columns that clash with the operators' own."""

    def make(rows):
        extra = [(i, t, f"own {n}", 0.5, n) for n, (i, t) in enumerate(rows)]
        return spark.createDataFrame(extra, "doc_id long, text string, kept string, score double, row_key long")

    return make
