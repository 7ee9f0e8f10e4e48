"""Every registered query equals its independent DuckDB SQL (exact values)."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL, SF_TINY
from fleetframe.plans.queries import REGISTRY
from oracle.compare import compare, duck_connection

# The optional folder's queries have tests of their own (some have no SQL form).
QUERIES = {name: fn for name, fn in entry.queries().items() if name in REGISTRY}
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in REGISTRY}


def test_every_query_has_oracle():
    assert set(QUERIES) == set(SQL) == set(REGISTRY)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle_tiny(spark, name):
    r = compare(spark, name, QUERIES[name], SQL[name], SF_TINY, duck_connection(SF_TINY))
    assert r["match"], r


@pytest.mark.parametrize("name", ["silver_trips", "route_patterns", "feature_table",
                                  "priority_order_history"])
def test_query_matches_oracle_small(spark, name):
    r = compare(spark, name, QUERIES[name], SQL[name], SF_SMALL, duck_connection(SF_SMALL))
    assert r["match"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "distance_km" in df.columns


@pytest.mark.parametrize("name", ["vehicle_history_30", "route_history_10", "feature_table",
                                  "priority_order_history"])
def test_split_key_plan_matches_oracle(spark, name):
    """Force the chunked (hot key) history plan and compare with the oracle."""
    spark.conf.set("fleetframe.history.maxKeyRows", "20")
    try:
        r = compare(spark, name, QUERIES[name], SQL[name], SF_SMALL, duck_connection(SF_SMALL))
    finally:
        spark.conf.unset("fleetframe.history.maxKeyRows")
    assert r["match"], r


_DUCK_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
              "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def test_column_types_match_oracle(spark):
    con = duck_connection(SF_TINY)
    for name, fn in QUERIES.items():
        rel = con.sql(SQL[name])
        duck = dict(zip(rel.columns, [str(t) for t in rel.types]))
        for column, spark_type in fn(spark, SF_TINY).dtypes:
            assert _DUCK_TYPE.get(spark_type, spark_type) == duck[column], (name, column)


@pytest.mark.parametrize("name", ["telemetry_view", "trip_datetimes", "trip_calendar", "silver_trips",
                                  "priority_order_history"])
def test_results_do_not_depend_on_session_time_zone(spark, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        r = compare(spark, name, QUERIES[name], SQL[name], SF_TINY, duck_connection(SF_TINY))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r["match"], r
