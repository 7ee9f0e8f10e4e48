"""Feature table invariance: input partitioning and window plan do not change results."""

from conftest import SF_TINY, rows_of
from fleetframe.operators.cleaning import clean_telemetry
from fleetframe.operators.features import build_features
from fleetframe.operators.trips import build_trips
from fleetframe.sources.testbed import read_table, telemetry_from_events


def _features(spark, parts, chunks=None):
    events = read_table(spark, SF_TINY, "events").repartition(parts)
    trips = build_trips(clean_telemetry(telemetry_from_events(events)))
    out = build_features(trips, chunks=chunks)
    return rows_of(out.drop("feature_timestamp"))


def test_invariant_to_input_partitioning_and_split_plan(spark):
    base = _features(spark, 1)
    assert len(base) > 0
    assert _features(spark, 7) == base
    spark.conf.set("fleetframe.history.maxKeyRows", "5")
    try:
        assert _features(spark, 5, chunks=6) == base
    finally:
        spark.conf.unset("fleetframe.history.maxKeyRows")
