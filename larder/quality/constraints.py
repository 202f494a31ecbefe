"""The constraints a suite is made of.

A constraint is met when its metric, a share of rows, is exactly 1. All kinds
but uniqueness are a condition on one row, so any number of them is a single
aggregation; uniqueness needs the values grouped and is handled by the suite.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Constraint:
    """One rule: its kind, the column it is about, its label, and the condition.

    ``holds`` takes the column's type and returns the condition a row must meet;
    it is None for uniqueness.
    """

    kind: str
    column: str
    label: str
    holds: Callable[[T.DataType], Column] | None = None


COMPLETE, UNIQUE, COMPLIANT = "complete", "unique", "compliant"


# Label formats of the validation report.
COMPLETENESS_LABEL = "CompletenessConstraint(Completeness({column},None))"
UNIQUENESS_LABEL = "UniquenessConstraint(Uniqueness(List({column}),None))"
COMPLIANCE_LABEL = "ComplianceConstraint(Compliance({name},{predicate},None))"
CONTAINED_NAME = "{column} contained in {values}"
CONTAINED_PREDICATE = "`{column}` IS NULL OR `{column}` IN ({quoted})"
NON_NEGATIVE_NAME = "{column} is non-negative"
NON_NEGATIVE_PREDICATE = "COALESCE(CAST({column} AS DECIMAL(20,10)), 0.0) >= 0"


def _column(name: str) -> Column:
    return F.col(f"`{name}`")


def _compliance(
    column: str, name: str, predicate: str, holds: Callable[[T.DataType], Column]
) -> Constraint:
    label = COMPLIANCE_LABEL.format(name=name, predicate=predicate)
    return Constraint(COMPLIANT, column, label, holds)


def complete(column: str) -> Constraint:
    """No NULL in the column; an empty string counts as a value."""
    label = COMPLETENESS_LABEL.format(column=column)
    return Constraint(COMPLETE, column, label, lambda _: _column(column).isNotNull())


def unique(column: str) -> Constraint:
    """Every value that is not NULL occurs once."""
    return Constraint(UNIQUE, column, UNIQUENESS_LABEL.format(column=column))


def contained_in(column: str, values: Sequence[str]) -> Constraint:
    """The value, as text, is one of the given ones, or NULL."""
    quoted = ",".join("'" + value.replace("'", "''") + "'" for value in values)
    return _compliance(
        column,
        CONTAINED_NAME.format(column=column, values=",".join(values)),
        CONTAINED_PREDICATE.format(column=column, quoted=quoted),
        lambda _: _column(column).isNull() | _column(column).cast("string").isin(list(values)),
    )


def non_negative(column: str) -> Constraint:
    """The value as ``decimal(20,10)`` is not below zero.

    NULL, and whatever that type cannot hold, counts as zero: so the rule says
    nothing about text that is no number.
    """

    def holds(data_type: T.DataType) -> Column:
        value = F.coalesce(_column(column).try_cast("decimal(20,10)"), F.lit(0)) >= 0
        if not isinstance(data_type, T.StringType):
            return value
        # Text without a minus sign cannot be negative. Casting text that is no
        # number is slow, so most of it is spared the cast.
        return F.when(F.contains(_column(column), F.lit("-")), value).otherwise(F.lit(True))

    return _compliance(
        column,
        NON_NEGATIVE_NAME.format(column=column),
        NON_NEGATIVE_PREDICATE.format(column=column),
        holds,
    )


def is_null(column: str) -> Constraint:
    """The column holds nothing but NULL."""
    return _compliance(
        column,
        f"{column} is null",
        f"`{column}` IS NULL",
        lambda _: _column(column).isNull(),
    )


def _unless_null(
    column: str, name: str, predicate: str, condition: Callable[[Column], Column]
) -> Constraint:
    """A condition on values; NULL is the business of ``complete``, so it passes."""
    return _compliance(
        column,
        f"{column} {name}",
        f"`{column}` IS NULL OR {predicate}",
        lambda _: _column(column).isNull() | condition(_column(column)),
    )


def _number_unless_null(
    column: str, name: str, predicate: str, condition: Callable[[Column], Column]
) -> Constraint:
    """A condition on numbers; text is read as a number, and fails if it is none."""

    def holds(data_type: T.DataType) -> Column:
        value = _column(column)
        if isinstance(data_type, T.StringType):
            value = value.try_cast("double")
        return _column(column).isNull() | condition(value)

    return _compliance(column, f"{column} {name}", f"`{column}` IS NULL OR {predicate}", holds)


def in_range(column: str, lower: float, upper: float) -> Constraint:
    """The value lies between two bounds, both included, or is NULL."""
    return _number_unless_null(
        column,
        f"between {lower} and {upper}",
        f"`{column}` BETWEEN {lower} AND {upper}",
        lambda value: value.between(F.lit(lower), F.lit(upper)),
    )


def less_than(column: str, bound: float) -> Constraint:
    """The value is below the bound, or NULL."""
    return _number_unless_null(
        column,
        f"less than {bound}",
        f"`{column}` < {bound}",
        lambda value: value < F.lit(bound),
    )


def greater_than(column: str, bound: float) -> Constraint:
    """The value is above the bound, or NULL."""
    return _number_unless_null(
        column,
        f"greater than {bound}",
        f"`{column}` > {bound}",
        lambda value: value > F.lit(bound),
    )


def upper_case(column: str) -> Constraint:
    """The text is its own upper-case form, or NULL."""
    return _unless_null(
        column,
        "is upper case",
        f"`{column}` = UPPER(`{column}`)",
        lambda value: value == F.upper(value),
    )


def lower_case(column: str) -> Constraint:
    """The text is its own lower-case form, or NULL."""
    return _unless_null(
        column,
        "is lower case",
        f"`{column}` = LOWER(`{column}`)",
        lambda value: value == F.lower(value),
    )


def trimmed(column: str) -> Constraint:
    """The text neither starts nor ends with a blank, or is NULL."""
    return _unless_null(
        column,
        "is trimmed",
        f"`{column}` = TRIM(`{column}`)",
        lambda value: value == F.trim(value),
    )
