"""Every registered query against its SQL, on the smallest data folder."""

import pytest

import __spark_entry__ as entry
from check_oracles import compare

from greenshoe.cases.registry import ORACLES, QUERIES


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


def test_all_are_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, folder, name):
    outcome, _, _ = compare(spark, folder, name, QUERIES[name], ORACLES.get(name))
    assert outcome == "equal"


def test_entry(spark):
    fact = entry.entry(spark)
    assert fact.columns[0] == "cik" and fact.columns[-1] == "valuation_flag"
    assert len(fact.columns) == 20 and fact.count() > 0
