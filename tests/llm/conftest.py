import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make(spark):
    """Documents from (doc_id, text[, lang, source]); n_chars follows."""

    def docs(*rows, schema=DOCS):
        full = []
        for row in rows:
            doc_id, text, lang, source = (*row, *(None,) * 4)[:4]
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        return spark.createDataFrame(full, schema)

    return docs

