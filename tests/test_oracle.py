"""Every SQL-checkable operator key against its DuckDB oracle (sf0.001)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from conftest import SF_SMALL  # noqa: E402
from locusframe.catalog import load_all  # noqa: E402
from oracle_check import compare  # noqa: E402

SQL_KEYS = sorted(k for k, v in load_all().items() if v.sql)


@pytest.mark.parametrize("key", SQL_KEYS)
def test_matches_oracle(spark, duck, registry, key):
    r = compare(spark, duck, registry[key], SF_SMALL)
    assert r["status"] == "ok", r


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
