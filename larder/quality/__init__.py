"""Declarative constraint suites, evaluated as aggregates and reported as rows."""

from larder.quality.constraints import (
    Constraint,
    complete,
    contained_in,
    greater_than,
    in_range,
    is_null,
    less_than,
    lower_case,
    non_negative,
    trimmed,
    unique,
    upper_case,
)
from larder.quality.gate import QualityGateError, enforce, verdict
from larder.quality.report import format_report
from larder.quality.suite import SUITES, Suite, run_suite, suite_for, suite_metrics

__all__ = [
    "SUITES",
    "Constraint",
    "QualityGateError",
    "Suite",
    "complete",
    "contained_in",
    "enforce",
    "format_report",
    "greater_than",
    "in_range",
    "is_null",
    "less_than",
    "lower_case",
    "non_negative",
    "run_suite",
    "suite_for",
    "suite_metrics",
    "trimmed",
    "unique",
    "upper_case",
    "verdict",
]
