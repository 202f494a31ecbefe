"""The operators bound to the benchmark tables, each with the SQL it must agree with."""

from larder.bindings import checks, comparisons, files, streams, transforms
from larder.bindings.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "checks", "comparisons", "files", "streams", "transforms"]
