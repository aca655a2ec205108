import os

import pytest

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(ROOT):
        pytest.skip("test tables are not here")
    return ROOT


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (doc_id, text) pairs, with columns whose names clash with results."""

    def make(rows):
        schema = "doc_id long, text string, n_tokens string, component_id string, kept string, digest string, sequence_id string"
        return spark.createDataFrame([(i, t, "x", "x", "x", "x", "x") for i, t in rows], schema)

    return make
