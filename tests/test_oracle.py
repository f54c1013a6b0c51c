"""Registered queries against the DuckDB oracle on the smallest binding."""

import pytest

from oracle_check import compare, duck

SMALL = "/root/testdata/sf0.001"
KEYS = [
    "bronze_zone_profile",
    "trip_duplicates",
    "silver_trips",
    "quarantine_trips",
    "dim_date",
    "fact_trips",
    "kpi_baseline",
    "silver_validation",
    "gold_validation",
    "expectations_fact",
    "gold_fact_counts",
    "gold_record_parity",
    "trips_by_hour",
    "fact_routes_approx",
]


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    from __spark_entry__ import oracle_sql, queries

    ok, msg = compare(queries()[key](spark, SMALL).toPandas(), con.sql(oracle_sql()[key]).df())
    assert ok, msg


def test_every_key_of_the_reference_operators_has_sql():
    from __spark_entry__ import oracle_sql

    from tripmart.plans.registry import QUERIES

    assert set(QUERIES) <= set(oracle_sql())


def test_oracle_takes_nothing_from_the_plans():
    import pathlib

    import tripmart.oracle

    for path in pathlib.Path(tripmart.oracle.__path__[0]).glob("*.py"):
        text = path.read_text()
        assert "tripmart.plans" not in text and "tripmart.operators" not in text


def test_a_wrong_predicate_turns_its_key_red(spark, con, monkeypatch):
    import dataclasses

    from __spark_entry__ import oracle_sql

    from tripmart.operators import contract
    from tripmart.plans import validation
    from tripmart.plans.lake import Lake

    wrong = dataclasses.replace(contract.METRICS["passenger"], blocked_by=("PASSENGER_COUNT_MISSING",))
    lake = Lake.of_run(spark, SMALL)
    lake.trips_classified
    monkeypatch.setitem(contract.METRICS, "passenger", wrong)
    got = validation.silver_contract_counts(lake).toPandas()
    assert not compare(got, con.sql(oracle_sql()["silver_contract_counts"]).df())[0]
