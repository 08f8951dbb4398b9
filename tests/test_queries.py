"""Every query of the inventory against its SQL, over the smallest tables."""

import __spark_entry__ as entry
import pytest
from conftest import DATA, oracle_rows, rows_of

from salvor.queries import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, oracle, name):
    df = registry.QUERIES[name](spark, DATA)
    names, want = oracle_rows(oracle, registry.ORACLES[name])
    assert sorted(df.columns) == names
    assert rows_of(df) == want


def test_every_query_has_its_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() == 3
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_needs_no_session_to_be_imported():
    import subprocess
    import sys

    from conftest import ROOT

    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=ROOT, capture_output=True, text=True, check=False)
    assert out.returncode == 0, out.stderr
