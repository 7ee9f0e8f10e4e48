"""Ordinal buckets with upper-inclusive edges; NULL falls in the top bucket."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from fleetframe.functions.numeric import _c

# Bucket edges (km and km/h).
DISTANCE_EDGES = (5, 15, 30)
SPEED_EDGES = (30, 60)


def bucket(x, edges) -> Column:
    """0.0 for x <= edges[0], 1.0 for x <= edges[1], ..., len(edges) otherwise."""
    x = _c(x)
    expr = None
    for i, edge in enumerate(edges):
        expr = F.when(x <= edge, F.lit(float(i))) if expr is None else expr.when(x <= edge, F.lit(float(i)))
    return expr.otherwise(F.lit(float(len(edges))))


def distance_category(x="distance_km") -> Column:
    return bucket(x, DISTANCE_EDGES)


def speed_category(x="avg_speed_kmh") -> Column:
    return bucket(x, SPEED_EDGES)
