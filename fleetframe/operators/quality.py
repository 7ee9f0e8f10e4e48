"""Row-quality rules: drop rows that fail, count how many failed.

A row is kept iff every rule's predicate is TRUE (NULL counts as failed).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    condition: str  # Spark SQL boolean expression

    def passed(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


# Rules the trip table enforces (drop on failure).
SILVER_RULES = (
    Rule("valid_trip", "trip_count > 0"),
    Rule("valid_duration", "duration_seconds > 0"),
)

# Stricter, optional set: positive distance and energy, critical keys present.
STRICT_RULES = SILVER_RULES + (
    Rule("valid_distance", "distance_km > 0"),
    Rule("valid_energy", "total_energy_consumption > 0"),
    Rule("critical_not_null",
         "VehId IS NOT NULL AND Trip IS NOT NULL AND DayNum IS NOT NULL AND start_timestamp_ms IS NOT NULL"),
)

# Declared key constraints of the feature table (fail, not drop).
FEATURE_KEY_RULES = (
    Rule("pk_vehid_notnull", "VehId IS NOT NULL"),
    Rule("pk_trip_notnull", "Trip IS NOT NULL"),
)


def all_passed(rules) -> Column:
    return reduce(lambda a, b: a & b, [r.passed() for r in rules])


def expect_or_drop(df: DataFrame, rules) -> DataFrame:
    rules = tuple(rules)
    return df.filter(all_passed(rules)) if rules else df


def observe_and_drop(df: DataFrame, rules, name: str = "quality") -> tuple[DataFrame, Observation]:
    """Filter by ``rules``; the Observation holds per-rule failure counts after
    the first action on the returned frame (no extra pass over the data).

    Counts cover every execution of the plan: use it on a plan that runs once
    (a plain write), not under a range-partitioned write, whose sampling pass
    executes the input a second time."""
    rules = tuple(rules)
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows_in")]
    metrics += [F.count_if(~r.passed()).alias(f"failed_{r.name}") for r in rules]
    observed = df.observe(obs, *metrics)
    return expect_or_drop(observed, rules), obs


def rule_metrics(df: DataFrame, rules) -> DataFrame:
    """One row per rule: ``rule, rows_checked, rows_passed, rows_failed``.

    A single aggregate pass (partial counts per task), then a tiny unpivot.
    """
    rules = tuple(rules)
    aggs = [F.count(F.lit(1)).alias("rows_checked")]
    aggs += [F.count_if(r.passed()).alias(f"p{i}") for i, r in enumerate(rules)]
    counts = df.agg(*aggs)
    stacked = F.explode(F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.col(f"p{i}").alias("rows_passed"))
        for i, r in enumerate(rules)]))
    return (counts.select("rows_checked", stacked.alias("m"))
            .select(F.col("m.rule").alias("rule"), "rows_checked",
                    F.col("m.rows_passed").alias("rows_passed"),
                    (F.col("rows_checked") - F.col("m.rows_passed")).alias("rows_failed")))


def key_violations(df: DataFrame, keys) -> DataFrame:
    """Keys that more than one row holds (NULL parts compare equal): ``*keys, n_rows``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


class ConstraintError(ValueError):
    """Rows that a table must not hold; ``failures`` counts them by constraint."""

    def __init__(self, failures: dict[str, int]):
        self.failures = failures
        super().__init__("constraint violated: " + ", ".join(f"{k}: {n} rows" for k, n in failures.items()))


def audit(df: DataFrame, rules=(), unique=()) -> dict[str, int]:
    """Rows that break each of ``rules``, and rows beyond the first of each ``unique`` key;
    constraints without violations are left out.  One pass for the rules, one shuffle of
    the key columns for the key."""
    failures = {}
    if rules:
        failures = {r["rule"]: r["rows_failed"] for r in rule_metrics(df, rules).collect() if r["rows_failed"]}
    if unique:
        again = key_violations(df, unique).agg(F.sum(F.col("n_rows") - 1)).first()[0]
        if again:
            failures[f"unique({', '.join(unique)})"] = again
    return failures


def require(df: DataFrame, rules=(), unique=()) -> None:
    """Raise ``ConstraintError`` if any row violates ``rules`` or repeats a ``unique`` key."""
    failures = audit(df, rules, unique)
    if failures:
        raise ConstraintError(failures)
