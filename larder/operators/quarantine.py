"""Setting unusable rows aside with the reason, instead of failing the job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import duration_problem
from larder.schemas import CORRUPT_COLUMN

REASON = "reason"
RECIPE_DURATIONS = ("cookTime", "prepTime")


def tag_reason(
    df: DataFrame,
    durations: Sequence[str] = RECIPE_DURATIONS,
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add the first reason for which a row is unusable, NULL if there is none.

    A line the JSON reader could not parse comes first (where the scan kept such
    lines), then the duration columns as ``missing <name>`` or ``malformed
    <name>``, then the ``extra`` conditions, keyed by the reason to report. A column
    that is called ``reason`` already is refused, not overwritten.
    """
    if REASON in (name.lower() for name in df.columns):
        raise ValueError(f"rename the column {REASON!r} first")
    reasons = []
    if CORRUPT_COLUMN in df.columns:
        reasons.append(F.when(F.col(CORRUPT_COLUMN).isNotNull(), F.lit("corrupt record")))
    for name in durations:
        reasons.append(F.concat(duration_problem(name), F.lit(f" {name}")))
    for reason, condition in (extra or {}).items():
        reasons.append(F.when(condition, F.lit(reason)))
    return df.withColumn(REASON, F.coalesce(*reasons))


def quarantined(df: DataFrame, **rules) -> DataFrame:
    """Only the unusable rows, each with its reason."""
    return tag_reason(df, **rules).where(F.col(REASON).isNotNull())


def usable(df: DataFrame, **rules) -> DataFrame:
    """Only the usable rows, with the columns they came with."""
    return tag_reason(df, **rules).where(F.col(REASON).isNull()).drop(REASON)
