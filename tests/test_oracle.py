"""Every query against its SQL counterpart, and the contract of the entry module."""

import subprocess
import sys
from pathlib import Path

import oracle_check
import pytest

import __spark_entry__ as entry
from shiplabel.plans.oracles import ORACLES
from shiplabel.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_check.connect(SF)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert oracle_check.compare(QUERIES[name](spark, SF), con, ORACLES[name]) == []


def test_import_needs_no_session():
    code = "import __spark_entry__ as e; assert e.queries() and e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=Path(entry.__file__).parent, check=True)


def test_entry(spark):
    flat = entry.entry(spark)
    assert flat.count() > 0 and "attr_Color" in flat.columns
