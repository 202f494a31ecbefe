"""Suites and their evaluation.

However many constraints a suite has, its input is scanned at most twice: once
for the row conditions, which end in one row without moving any data, and once
for all unique columns together, whose values go through a single shuffle. The
completeness of a unique column comes out of the second scan as well, so in a
suite of these two kinds no column is read twice.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import group_key
from larder.quality.constraints import (
    COMPLETE,
    UNIQUE,
    Constraint,
    complete,
    contained_in,
    non_negative,
    unique,
)


@dataclass(frozen=True)
class Suite:
    """A named list of constraints; their position is their number in the report."""

    name: str
    constraints: tuple[Constraint, ...]

    @property
    def columns(self) -> list[str]:
        """The columns the suite reads, each once."""
        return list(dict.fromkeys(c.column for c in self.constraints))


# The rules of the two datasets, in the order of their numbers.
RECIPE_SUITE = Suite(
    "recipe",
    (
        complete("name"),
        complete("cookTime"),
        complete("prepTime"),
        complete("ingredients"),
        complete("image"),
        complete("url"),
        unique("name"),
        unique("ingredients"),
        unique("url"),
    ),
)

RECIPE_AGGREGATE_SUITE = Suite(
    "recipe_aggregate",
    (
        complete("difficulty"),
        complete("avg_total_cooking_time"),
        contained_in("difficulty", ["easy", "medium", "hard"]),
        unique("difficulty"),
        non_negative("avg_total_cooking_time"),
    ),
)

SUITES = {suite.name: suite for suite in (RECIPE_SUITE, RECIPE_AGGREGATE_SUITE)}


def suite_for(dataset: str) -> Suite:
    """The suite of a dataset given by name, or by a ``|``-separated path ending in it."""
    name = dataset.split("|")[-1].lower()
    if name not in SUITES:
        raise KeyError(f"no suite for dataset {name!r}; known: {', '.join(sorted(SUITES))}")
    return SUITES[name]


Numbered = list[tuple[int, Constraint]]


def _metric_rows(*entries: tuple[Column, Column]) -> Column:
    """Pairs ``ordinal, metric`` of one row turned into rows."""
    return F.inline(
        F.array(*[F.struct(i.alias("ordinal"), m.alias("metric")) for i, m in entries])
    )


def _row_metrics(df: DataFrame, constraints: Numbered) -> DataFrame:
    """Metrics of row conditions: one scan, one partial and one final aggregate."""
    counts = [
        F.count_if(c.holds(df.schema[c.column].dataType)).alias(f"n{i}") for i, c in constraints
    ]
    totals = df.agg(F.count(F.lit(1)).alias("n"), *counts)
    # No rows, no report: an aggregate without keys still gives a row for them.
    return totals.where(F.col("n") > 0).select(
        _metric_rows(*[(F.lit(i), F.col(f"n{i}") / F.col("n")) for i, _ in constraints])
    )


def _value_metrics(df: DataFrame, unique: Numbered, complete: Numbered) -> DataFrame:
    """Metrics of unique columns: one scan and one shuffle of keys of bounded width.

    Grouping sets give each row once per column. Values are counted before the
    shuffle, so a value held by a third of all rows arrives as one row per task.
    ``complete`` are completeness rules on columns among the unique ones.
    """
    columns = list(dict.fromkeys(c.column for _, c in unique))
    names = [f"k{place}" for place in range(len(columns))]
    counts = (
        df.select(*[group_key(df, c).alias(name) for c, name in zip(columns, names)])
        .groupingSets([[name] for name in names], *names)
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.grouping(name).alias(f"out_{name}") for name in names],
        )
    )
    column = F.coalesce(
        *[F.when(F.col(f"out_{name}") == 0, F.lit(c)) for c, name in zip(columns, names)]
    )
    filled = reduce(or_, [F.col(name).isNotNull() for name in names])
    totals = (
        counts.select(column.alias("column"), filled.alias("filled"), "n")
        .groupBy("column")
        .agg(
            F.sum("n").alias("rows"),
            F.sum(F.when(F.col("filled"), F.col("n")).otherwise(0)).alias("values"),
            F.count_if(F.col("filled") & (F.col("n") == 1)).alias("once"),
        )
    )
    # A column of NULLs alone has no share of unique values: the metric is NULL
    # and the rule fails.
    metrics = [(i, c, F.try_divide("once", "values")) for i, c in unique]
    metrics += [(i, c, F.col("values") / F.col("rows")) for i, c in complete]
    return totals.select(
        _metric_rows(
            *[(F.when(F.col("column") == c.column, F.lit(i)), metric) for i, c, metric in metrics]
        )
    ).where(F.col("ordinal").isNotNull())


def suite_metrics(df: DataFrame, suite: Suite) -> DataFrame:
    """``(ordinal, metric)`` for each constraint; no rows if ``df`` has none.

    Lazy: nothing runs before the result is used.
    """
    numbered = list(enumerate(suite.constraints))
    unique = [(i, c) for i, c in numbered if c.kind == UNIQUE]
    grouped = {c.column for _, c in unique}
    complete = [(i, c) for i, c in numbered if c.kind == COMPLETE and c.column in grouped]
    rest = [entry for entry in numbered if entry not in unique and entry not in complete]
    parts = []
    if rest:
        parts.append(_row_metrics(df, rest))
    if unique:
        parts.append(_value_metrics(df, unique, complete))
    return reduce(DataFrame.unionByName, parts)


def unique_columns(suite: Suite) -> list[str]:
    """The columns that have to be unique, each once."""
    return list(dict.fromkeys(c.column for c in suite.constraints if c.kind == UNIQUE))


#: What a run of a suite gives.
RESULTS = "ordinal int, check string, constraint string, metric double, constraint_status string"


def labelled(metrics: DataFrame, suite: Suite, check: str | None = None) -> DataFrame:
    """Metrics with the name of the check, the constraint's label and the status."""
    labels = F.array(*[F.lit(c.label) for c in suite.constraints])
    return metrics.select(
        "ordinal",
        F.lit(check or suite.name).alias("check"),
        F.element_at(labels, F.col("ordinal") + 1).alias("constraint"),
        "metric",
        F.when(F.col("metric") == 1.0, "Success").otherwise("Failure").alias("constraint_status"),
    )


def run_suite(df: DataFrame, suite: Suite, check: str | None = None) -> DataFrame:
    """Results as rows ``ordinal, check, constraint, metric, constraint_status``."""
    return labelled(suite_metrics(df, suite), suite, check)
