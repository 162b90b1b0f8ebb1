"""Every query against the SQL over the same tables, doubles to the bit."""

import pytest
from helpers import plan_of

import __spark_entry__ as entry
from checks import compare, oracles
from checks.queries import registered

QUERIES = registered()
ORACLES = oracles.ORACLES


UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow", "PythonUDF")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, sf_dir, sql, name):
    result = QUERIES[name](spark, sf_dir)
    assert compare.difference(result, sql, ORACLES[name]) is None
    plan = plan_of(result)
    assert not [node for node in UNWANTED if node in plan]


def test_every_oracle_has_a_query():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry_gives_rows(spark):
    assert not entry.entry(spark).isEmpty()


def test_random_sample_is_a_subset_near_the_target(spark, sf_dir):
    from checks import fixtures
    from tripweave.operators.sampling import sample_to_target

    trips = fixtures.trips(spark, sf_dir)
    sample = sample_to_target(trips, target=300, seed=42)
    ids = {r.ride_id for r in trips.collect()}
    got = [r.ride_id for r in sample.collect()]
    assert len(set(got)) == len(got) and set(got) <= ids and 200 < len(got) < 400
    assert sorted(got) == sorted(r.ride_id for r in sample_to_target(trips, target=300, seed=42).collect())
