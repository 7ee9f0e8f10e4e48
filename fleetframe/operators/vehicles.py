"""Vehicle classes from which signals a vehicle ever emits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from fleetframe.schema import BATTERY_SIGNALS, BEV_LABEL, COMBUSTION_SIGNALS


def _any_present(cols: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in cols])


def signal_flags(samples: DataFrame) -> dict[str, Column]:
    """Per-sample 0/1 presence of any combustion / any battery signal."""
    return {
        "has_combustion": F.when(_any_present(COMBUSTION_SIGNALS), F.lit(1)).otherwise(F.lit(0)),
        "has_battery": F.when(_any_present(BATTERY_SIGNALS), F.lit(1)).otherwise(F.lit(0)),
    }


def vehicle_signals(samples: DataFrame) -> DataFrame:
    """One row per ``VehId`` with ``has_combustion`` and ``has_battery`` (0/1).

    Reads only the key and the six signal columns; ``max`` is combined map-side,
    so only one partial row per vehicle and task is shuffled, however many
    samples a vehicle has.
    """
    flags = signal_flags(samples)
    return samples.groupBy("VehId").agg(*[F.max(expr).alias(name) for name, expr in flags.items()])


def ev_vehicles(samples: DataFrame) -> DataFrame:
    """Battery-electric vehicles: battery signal present, combustion signal never."""
    return (vehicle_signals(samples)
            .filter((F.col("has_battery") == 1) & (F.col("has_combustion") == 0))
            .select("VehId", F.lit(BEV_LABEL).alias("vehicle_type")))
