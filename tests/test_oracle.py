"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

from oracle_check import rows_of  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from conftest import SF_SMALL  # noqa: E402

ORACLE = E.oracle_sql()
QUERIES = E.queries()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_SMALL).toPandas()
    odf = duck.execute(ORACLE[name]).df()
    sc, sr = rows_of(sdf)
    oc, orr = rows_of(odf)
    assert sc == oc
    assert len(sr) == len(orr)
    assert sr == orr


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() >= 0


def test_every_query_has_unique_name():
    assert len(QUERIES) == len(set(QUERIES))


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
