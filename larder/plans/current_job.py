"""Batch job: one day's load of the typed layer into the current state of the archive.

    spark-submit --py-files larder.zip larder/plans/current_job.py \\
        --layer LAYER --current CURRENT --day 2019-11-29 [--output OUT] [--keep 30]
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators.compare import latest_by_key
from larder.operators.recipes import add_difficulty, average_by, keyword_filter
from larder.sources import STATUS_OK, read_days, write_files
from larder.sources.landing import EXECUTION_DAY
from larder.sources.published import (
    drop_editions,
    edition,
    hash_bucket,
    publish,
    read_parts,
    replaced,
    write_parts,
)

log = logging.getLogger(__name__)

KEY = "url"
#: Of two rows of a URL the one loaded later counts, then the one published later.
VERSION = (EXECUTION_DAY, "datePublished")
STATE = ("name", "ingredients", "image", "prepTimeMinutes", "cookTimeMinutes")
ROWS = "rows"
#: Parts of the state. A day rewrites those that hold one of its URLs, so take more of
#: them than a day has URLs to gain by it; the number of a table is that of its first day.
BUCKETS = 256


def merge_day(
    spark: SparkSession, layer_path: str, current_path: str, day: dt.date, buckets: int = BUCKETS
) -> None:
    """Publish the state after a day: each URL once, as its newest usable row gives it.

    Reads the day's load and those buckets of the state before it that hold one of the
    load's URLs; other buckets are neither read nor written, and the new state names
    their old files. Readers see the state before the day or after it, and earlier
    states stay readable until ``drop_editions`` drops them. When a day is loaded again,
    merge it and the days after it again. Rows that cannot be used, or have no URL,
    leave the state as it was.
    """
    load = read_days(spark, layer_path, day, day_column=EXECUTION_DAY)
    load = load.where((F.col("status") == STATUS_OK) & F.col(KEY).isNotNull())
    rows = load.select(KEY, *VERSION, *STATE)
    label = str(day)
    base = edition(spark, current_path, before=label)
    buckets = base.facts["buckets"] if base else buckets
    bucket = hash_bucket(F.col(KEY), buckets)
    touched = [r["bucket"] for r in rows.select(bucket.alias("bucket")).distinct().collect()]
    if base:
        rows = rows.unionByName(read_parts(spark, current_path, base, ROWS, touched))
    state = latest_by_key(rows, KEY, VERSION, STATE)
    made = write_parts(state, current_path, label, bucket)
    facts = {"buckets": buckets}
    publish(spark, current_path, replaced(base, label, ROWS, made, state.schema, touched, facts))
    log.info("merged %s: %d of %d buckets", day, len(touched), buckets)


def read_current(spark: SparkSession, current_path: str, day: dt.date | None = None) -> DataFrame:
    """The state after the last merged day, or after the last one up to a day."""
    found = edition(spark, current_path, until=None if day is None else str(day))
    if found is None:
        raise ValueError(f"no state {'yet' if day is None else f'up to {day}'} at {current_path}")
    return read_parts(spark, current_path, found, ROWS)


def current_average(
    spark: SparkSession, current_path: str, day: dt.date, keyword: str = "beef"
) -> DataFrame:
    """The average total time per level over the state after a day, each recipe once."""
    state = read_current(spark, current_path, day)
    chosen = state.transform(keyword_filter, "ingredients", keyword)
    return chosen.transform(add_difficulty).transform(average_by)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--layer", required=True)
    parser.add_argument("--current", required=True)
    parser.add_argument("--day", required=True, type=dt.date.fromisoformat)
    parser.add_argument("--output")
    parser.add_argument("--keyword", default="beef")
    parser.add_argument("--keep", type=int, help="states to keep; all of them without it")
    options = parser.parse_args(arguments)
    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName("current recipes").getOrCreate()
    merge_day(spark, options.layer, options.current, options.day)
    if options.output:
        result = current_average(spark, options.current, options.day, options.keyword)
        write_files(result, options.output, "csv", single_file=True)
    if options.keep is not None:
        drop_editions(spark, options.current, options.keep)


if __name__ == "__main__":
    main()
