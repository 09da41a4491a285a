"""Every registered query against its independently written SQL, on whole tables."""

import compare
import pytest

import __spark_entry__ as entry_points
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def database():
    return compare.connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= entry_points.queries().items() and ORACLES.items() <= entry_points.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, database, name):
    assert compare.differences(spark, database, QUERIES[name], ORACLES[name], SF) == []


def test_entry_runs(spark):
    result = entry_points.entry(spark)
    assert result.columns == ["stateabbr", "projects", "total_obligated"]
    assert result.count() > 0
