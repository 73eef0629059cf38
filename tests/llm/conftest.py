import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def llm(spark):
    """The session with the package shipped to its workers."""
    from sparkmart.llm.common import ship

    ship(spark)
    return spark


DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def frame(llm):
    def make(texts, schema=DOC_SCHEMA, langs=None, sources=None):
        """documents from (doc_id, text) pairs."""
        rows = [
            (i, t, langs[k] if langs else None, sources[k] if sources else None, len(t) if t is not None else None)
            for k, (i, t) in enumerate(texts)
        ]
        return llm.createDataFrame(rows, schema)

    return make
