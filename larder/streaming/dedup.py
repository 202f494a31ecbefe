"""Events that arrive several times and late, landed once, with what came too late set aside."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from larder.operators.compare import _col
from larder.operators.quarantine import REASON
from larder.streaming.jobs import _shuffle_partitions, stream_to_partitions

#: What the quarantine says of a row that came behind the watermark.
LATE = "late"


def stream_deduplicated(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    key: Sequence[str],
    event_time: str,
    delay: str,
    partition_by: Sequence[str],
    interval: str | None = None,
    state_partitions: int = 8,
) -> StreamingQuery:
    """Land each key once, over batches and restarts, as long as its repeats come in time.

    A repeat is found if its time is no more than ``delay`` away from that of the row that
    was landed. A row whose time is further than ``delay`` behind the latest one of
    earlier batches is not landed: ``set_aside_late`` finds those. The state holds a key
    until the watermark is past its time and the delay, so it follows the rate of arrival
    and not the history. The number of state partitions is fixed by the first run.
    """
    watched = stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(key))
    with _shuffle_partitions(stream.sparkSession, state_partitions):
        return stream_to_partitions(watched, path, checkpoint, partition_by, interval)


def late_rows(arrivals: DataFrame, landed: DataFrame, key: Sequence[str]) -> DataFrame:
    """The arrivals whose key was never landed, each distinct row once, with the reason.

    A stream leaves out a row because its key is landed or because it came too late, so
    what has no landed key came too late. NULL keys compare as values. Give both sides of
    a span of days that the repeats and the delay lie in, not of the whole history. Keys
    are reduced before they meet, so a key with many repeats forms no pairs.
    """
    names = [f"__k{i}" for i in range(len(key))]
    known = landed.select(*[_col(k).alias(n) for k, n in zip(key, names, strict=True)]).distinct()
    same = [_col(k).eqNullSafe(F.col(n)) for k, n in zip(key, names, strict=True)]
    return arrivals.join(known, same, "left_anti").distinct().withColumn(REASON, F.lit(LATE))
