"""Every registered query against its SQL on the smallest shared tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

duckdb = pytest.importorskip("duckdb")

from __spark_entry__ import entry  # noqa: E402
from fieldprep.workload.registry import ORACLES, QUERIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="shared tables not present")


@pytest.fixture(scope="module")
def db():
    from compare import connect

    return connect(SF_DIR)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    from compare import compare

    ok, note = compare(spark, db, SF_DIR, name)
    assert ok, note
    assert "unstable" not in note, note
