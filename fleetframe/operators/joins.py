"""Joining against a side whose size is only known at run time.

``sized_for_broadcast`` materializes the small side once (to the shared
checkpoint folder), counts its rows from the written files, and reports
whether it fits under the session's broadcast threshold.  Callers pick a
broadcast plan when it fits and a shuffle plan otherwise, so nothing is
broadcast on an unproven size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from fleetframe.session import materialize

# Fixed value: Spark's own default threshold.
DEFAULT_BROADCAST_BYTES = 10 * 1024 * 1024


def broadcast_budget_bytes(spark) -> int:
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", str(DEFAULT_BROADCAST_BYTES))
    raw = raw.strip().lower()
    mult = 1
    for suffix, m in (("kb", 1 << 10), ("mb", 1 << 20), ("gb", 1 << 30), ("k", 1 << 10),
                      ("m", 1 << 20), ("g", 1 << 30), ("b", 1)):
        if raw.endswith(suffix):
            raw, mult = raw[: -len(suffix)], m
            break
    return int(float(raw) * mult)  # -1: the session wants no broadcast, and nothing fits


def sized_for_broadcast(small: DataFrame, row_bytes: int, tag: str,
                        written: bool = False) -> tuple[DataFrame, bool]:
    """(materialized ``small``, whether rows * row_bytes fits the broadcast budget).

    ``written``: ``small`` is already a scan of written files (count is cheap)."""
    spark = small.sparkSession
    if not written:
        small = materialize(small, tag)
    rows = small.count()
    written = small
    return written, rows * row_bytes <= broadcast_budget_bytes(spark)
