"""Registered queries against their SQL at the smallest scale, and all of them on tables without rows."""

import os

import pytest

from checks import compare, connect

from topicloom.llm import queries as q

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    difference, _ = compare(spark, con, q.queries()[name], q.oracle_sql()[name], SF)
    assert difference == ""


@pytest.fixture(scope="module")
def empty_tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "pages", "embeddings", "conversations"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{root}/{name}.parquet")
    return root


@pytest.mark.parametrize("name", sorted(q.queries()))
def test_empty_tables(spark, empty_tables, name):
    assert q.queries()[name](spark, empty_tables).count() == 0


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in q.queries()) == list(range(1, 14))


def test_nothing_else_imports_the_subpackage():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(q.__file__))))
    for folder, _, files in os.walk(os.path.join(root, "topicloom")):
        if os.path.basename(folder) not in ("llm", "__pycache__"):
            for file in files:
                if file.endswith(".py"):
                    with open(os.path.join(folder, file)) as f:
                        assert "llm" not in f.read(), file
