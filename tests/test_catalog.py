"""Every registered query against its SQL on the smallest given tables."""

import importlib.util
import os

import pytest

from tablecheck.catalog import ORACLE, QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF_DIR = "/root/testdata/sf0.001"

_spec = importlib.util.spec_from_file_location("compare", os.path.join(ROOT, "tools", "compare.py"))
compare = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(compare)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")


@pytest.fixture(scope="module")
def con():
    connection = compare.connect(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare.compare(spark, con, SF_DIR, name) is None


def test_entry(spark):
    spec = importlib.util.spec_from_file_location("entry_module", os.path.join(ROOT, "__spark_entry__.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    assert module.entry(spark).count() == 14
    assert set(module.oracle_sql()) <= set(module.queries())
