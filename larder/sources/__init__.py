"""Readers, writers and the partitioned parquet layer."""

from larder.sources.files import read_files, read_json_lines, write_files
from larder.sources.landing import (
    STATUS_OK,
    land_by_partition,
    preprocess_recipes,
    read_arrival_day,
    read_days,
    read_landed,
    rebalanced,
    type_recipes,
    write_arrivals,
)
from larder.sources.lookup import lookup, write_for_lookup
from larder.sources.workspace import checkpoint_ready, fresh_folder

__all__ = [
    "STATUS_OK",
    "checkpoint_ready",
    "fresh_folder",
    "land_by_partition",
    "lookup",
    "preprocess_recipes",
    "read_arrival_day",
    "read_days",
    "read_files",
    "read_json_lines",
    "read_landed",
    "rebalanced",
    "type_recipes",
    "write_arrivals",
    "write_files",
    "write_for_lookup",
]
