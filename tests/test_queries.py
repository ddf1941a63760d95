"""All registered queries against their SQL; ``python tests/oracle.py`` does the same on larger tables."""
from concurrent.futures import ThreadPoolExecutor

import pytest

import __spark_entry__ as entry
import oracle
from conftest import SF

OWN = sorted(set(entry.queries()) - set(entry.LLM_QUERIES))


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.fixture(scope="module")
def differences(spark):
    """What each query and its SQL differ in; several queries run at a time."""
    queries, sqls = entry.queries(), entry.oracle_sql()

    def compare(name: str) -> str | None:
        try:
            return oracle.difference(spark, oracle.connect(SF), SF, queries[name], sqls[name])
        except Exception as e:  # told by the query's own test
            return f"{type(e).__name__}: {e}"

    with ThreadPoolExecutor(4) as pool:
        return dict(zip(OWN, pool.map(compare, OWN)))


def test_every_query_has_sql():
    assert set(OWN) == set(entry.oracle_sql()) - set(entry.LLM_ORACLES)


@pytest.mark.parametrize("name", OWN)
def test_query(differences, name):
    assert differences[name] is None


def test_the_comparison_sees_differences(spark, con):
    fn = entry.queries()["qualified_name"]
    sql = entry.oracle_sql()["qualified_name"]
    assert oracle.difference(spark, con, SF, fn, sql) is None
    assert "rows" in oracle.difference(spark, con, SF, fn, sql + " WHERE p_partkey <> 3")
    assert "columns" in oracle.difference(spark, con, SF, fn, "SELECT 1 AS p_partkey")


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.count() > 0
    assert frame.columns[0] == "o_orderkey"
