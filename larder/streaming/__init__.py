"""The jobs as periodic micro-batches."""

from larder.streaming.current import current_average, stream_current_average
from larder.streaming.dedup import late_rows, stream_deduplicated
from larder.streaming.jobs import (
    latest_average,
    stream_average,
    stream_files,
    stream_to_layer,
    stream_to_partitions,
)

__all__ = [
    "current_average",
    "late_rows",
    "latest_average",
    "stream_average",
    "stream_current_average",
    "stream_deduplicated",
    "stream_files",
    "stream_to_layer",
    "stream_to_partitions",
]
