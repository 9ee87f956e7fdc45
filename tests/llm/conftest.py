import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with the other columns of the table and one that
    clashes with names that operators use inside."""

    def make(rows, **extra):
        full = [
            (i, t, extra.get("lang", "en"), f"src{k % 3}", len(t or ""), "x")
            for k, (i, t) in enumerate(rows)
        ]
        return spark.createDataFrame(
            full, "doc_id bigint, text string, lang string, source string, n_chars bigint, n string"
        )

    return make
