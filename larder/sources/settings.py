"""Settings that hold for one write or for the start of one stream."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ADVISORY_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
#: Shuffled bytes, compressed, that a task of a partitioned write is to take at most.
SLICE_BYTES = 16 << 20


@contextmanager
def setting(spark: SparkSession, name: str, value: str | int) -> Iterator[None]:
    """Another value of a session's setting in the block.

    A streaming query copies the settings when it starts, so a block around the start is
    enough and the session gets its own value back at once.
    """
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def size_in_bytes(text: str) -> int:
    """A size as Spark's settings give it: ``16m``, ``64MB``, ``1024``."""
    number, unit = re.fullmatch(r"\s*([0-9]+)\s*([bkmgtp]?)b?\s*", text.lower()).groups()
    return int(number) << 10 * "bkmgtp".index(unit or "b")


@contextmanager
def small_slices(spark: SparkSession) -> Iterator[None]:
    """Smaller tasks for rebalanced rows that are written, or whose stream starts, in the block.

    Adaptive execution splits a hot partition value by the shuffled, compressed size.
    The writer sorts its task's rows by partition value, and there they take some fifteen
    times as much: at Spark's own 64 MB a task sorts a GB. A smaller size that the
    session has already is kept.
    """
    if size_in_bytes(spark.conf.get(ADVISORY_SIZE)) <= SLICE_BYTES:
        yield
        return
    with setting(spark, ADVISORY_SIZE, SLICE_BYTES):
        yield
