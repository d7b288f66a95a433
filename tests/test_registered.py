"""Every registered query against its SQL on the small tables."""

import os

import pytest

import __spark_entry__ as entry
import check

SF_DIR = os.environ.get("MILLRACE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return check.duck(SF_DIR)


OWN = [name for name in entry.queries() if name not in entry.LLM]


def test_every_query_has_its_sql():
    assert set(OWN) <= entry.oracle_sql().keys() <= entry.queries().keys()


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["lon", "lat", "window_end_ms", "is_start", "n"] and df.count() > 0


@pytest.mark.parametrize("name", OWN)
def test_query(spark, con, name):
    assert check.compare(spark, con, SF_DIR, name) == ""
