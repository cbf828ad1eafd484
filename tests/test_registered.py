"""Every registered query against its SQL, on the smallest data set."""

import re

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences
from tests.conftest import SF

OWN_TESTS = re.compile(r"op\d+_|pipeline$")  # tested in tests/llm
QUERIES = {k: v for k, v in entry.queries().items() if not OWN_TESTS.match(k)}
ORACLE = {k: v for k, v in entry.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def db():
    return connect(SF)


def test_registry():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) <= {"classify_fit_predict"}


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "C_CUSTKEY" and df.count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF)
    rows = df.collect()
    if name in ORACLE:
        assert differences(df, rows, db, ORACLE[name]) == []
    else:
        assert rows
