"""Stopping a job on failed constraints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.quality.suite import Suite, run_suite


class QualityGateError(Exception):
    """At least one constraint failed; ``failures`` holds their labels."""

    def __init__(self, stage: str, failures: list[str]):
        super().__init__(f"{stage}: {len(failures)} failed: {'; '.join(failures)}")
        self.stage = stage
        self.failures = failures


def verdict(df: DataFrame, suite: Suite, stage: str) -> DataFrame:
    """One row ``stage, constraints, failures, verdict`` for a suite run on ``df``."""
    constraints = F.count(F.lit(1))
    failures = F.count_if(F.col("constraint_status") == "Failure")
    return run_suite(df, suite).agg(
        F.lit(stage).alias("stage"),
        constraints.alias("constraints"),
        failures.alias("failures"),
        F.when(constraints == 0, "empty")
        .when(failures == 0, "pass")
        .otherwise("stop")
        .alias("verdict"),
    )


def enforce(results: DataFrame, stage: str, allow_empty: bool = False) -> None:
    """Raise if any constraint failed, or if there was no row to check.

    Brings the labels to the driver: one per constraint of the
    suite, whatever the size of the data.
    """
    checked = results.orderBy("ordinal").select("constraint", "constraint_status").collect()
    if not checked and not allow_empty:
        raise QualityGateError(stage, ["no rows to check"])
    labels = [row["constraint"] for row in checked if row["constraint_status"] == "Failure"]
    if labels:
        raise QualityGateError(stage, labels)
