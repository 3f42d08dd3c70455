import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def docs(spark):
    """Documents of ``helpers.corpus`` with all columns of the table and two whose names clash with results."""
    from helpers import corpus

    rows = [(i, t, "en" if (i or 0) % 3 else None, f"host{(i or 0) % 4}" if (i or 0) % 5 else None, len(t or ""), "x", 7) for i, t in corpus()]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, `set` string, n_words int").repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.where("false")
