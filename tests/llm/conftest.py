import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_rows import EDGES, SMALL  # noqa: E402


@pytest.fixture
def edges(spark):
    """Documents of all kinds, with columns whose names clash with those the operators add."""
    rows = [(i, t, f"l{(i or 0) % 2}", None, len(t or ""), 9, "x") for i, t in EDGES]
    names = "doc_id long, text string, lang string, source string, n_chars long, n_words int, kept string"
    return spark.createDataFrame(rows, names)


@pytest.fixture
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
