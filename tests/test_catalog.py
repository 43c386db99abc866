"""Every registered query with SQL against that SQL, at the smallest scale."""

import os

import pytest

from checks import compare, connect

from topicloom import catalog

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_names():
    assert set(catalog.oracle_sql()) <= set(catalog.queries())


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    difference, _ = compare(spark, con, catalog.queries()[name], catalog.oracle_sql()[name], SF)
    assert difference == ""


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["File", "word", "termFreq_inverseDocFreq", "RowNumber"]
    assert df.count() > 0
