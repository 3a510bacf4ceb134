import os

import pytest

from tidemark.llm.shared import reachable

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def llm(spark):
    reachable(spark)
    return spark


@pytest.fixture(scope="session")
def tables(llm):
    if not os.path.isdir(SF):
        pytest.skip("the given tables are not here")
    return lambda name: llm.read.parquet(f"{SF}/{name}.parquet")


@pytest.fixture
def frame(llm):
    """Documents from texts (or ``(doc_id, text)`` pairs), with columns whose names clash with those of the operators."""

    def make(rows):
        full = [(r if isinstance(r, tuple) else (i, r)) for i, r in enumerate(rows)]
        rows = [(i, t, None, None, None if t is None else len(t), 1, 2, 3.0, "x") for i, t in full]
        return llm.createDataFrame(rows, SCHEMA + ", rep long, cell int, score double, key string")

    return make
