"""Plan inspection helpers (used by tests and the benchmark report)."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "simple") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def single_partition_exchanges(df: DataFrame) -> list[str]:
    """Each ``Exchange SinglePartition`` with the operator right below it.

    An exchange to one partition is only acceptable on top of a partial
    aggregate (a one-row-per-task result); anything else moves all rows
    into one task.
    """
    lines = plan_text(df).splitlines()
    out = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = next((l for l in lines[i + 1:] if l.strip()), "")
            out.append(below.strip())
    return out


def rows_to_one_task(df: DataFrame) -> bool:
    """True if some single-partition exchange is not fed by a partial aggregate."""
    return any(not ("HashAggregate" in b and "partial_" in b) for b in single_partition_exchanges(df))
