"""Every registered query against its SQL on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry
from check_oracles import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", entry.queries())
def test_query(spark, con, name):
    assert compare(spark, con, FOLDER, name, entry.queries()[name], entry.oracle_sql().get(name)) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 10


def test_auto_ids(spark):
    ids = sorted(r["id"] for r in entry.queries()["auto_id"](spark, FOLDER).collect())
    assert ids == list(range(1, 1001))
