import importlib
import re
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from cdcflow.operators import positions

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))
check = importlib.import_module("check")

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")

# The rest runs in tools/check.py; these touch each part of the package once.
SMOKE = (
    "apply_changes", "stream_committed", "redo_images", "rollback_pairs", "typed_changes", "pg9_changes", "decode_json",
    "string_to_typed_dirty", "segments_since", "column_dictionary", "write_mode_insert", "kafka_records",
)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in check.TABLES:
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return con


def test_every_query_has_a_twin():
    own = {n for n in entry.queries() if n != "pipeline" and not re.match(r"op\d+_", n)}
    assert own <= set(entry.oracle_sql())
    assert len(entry.queries()) > 90


def test_every_twin_is_valid_sql(duck):
    for name, sql in entry.oracle_sql().items():
        assert duck.execute(f"explain {sql}").fetchall(), name


# Every query whose operator has a sliced form.
SLICED = (
    "committed_changes", "rollback_pairs", "redo_stitched", "pg_changes", "pg9_changes", "snowflake_ids", "failure_runs", "even_segments",
    "restore_boundaries",
)


@pytest.mark.parametrize("name", SLICED)
def test_sliced_form_equals_twin(spark, duck, name, monkeypatch):
    monkeypatch.setattr(positions, "GROUP_LIMIT", 0)
    monkeypatch.setattr(positions, "ROWS_PER_SLICE", 150)
    test_query_equals_twin(spark, duck, name)


@pytest.mark.parametrize("name", SMOKE)
def test_query_equals_twin(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    cols = sorted(df.columns)
    got = Counter(tuple(check.norm(v) for v in r) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    rel = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    at = sorted(range(len(names)), key=lambda i: names[i])
    want = Counter(tuple(check.norm(r[i]) for i in at) for r in rel.fetchall())
    assert cols == sorted(names)
    assert got == want


def test_flagship_runs(spark):
    assert entry.entry(spark).count() > 0
