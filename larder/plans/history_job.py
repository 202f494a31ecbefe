"""Batch job: one day's dump into the validity history of the archive.

    spark-submit --py-files larder.zip larder/plans/history_job.py \\
        --layer LAYER --history HISTORY --day 2019-11-29
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators.compare import latest_by_key
from larder.operators.history import VALID_FROM, VALID_TO, last_valid_day, validity_history
from larder.operators.recipes import add_difficulty
from larder.sources import STATUS_OK, read_days, read_landed
from larder.sources.landing import EXECUTION_DAY
from larder.sources.published import (
    edition,
    hash_bucket,
    publish,
    read_parts,
    replaced,
    write_parts,
)
from larder.sources.workspace import checkpoint_ready

log = logging.getLogger(__name__)

KEY = "url"
#: What is tracked: a change of any of these begins a new interval.
TRACKED = ("name", "total", "level")
#: Of two rows of a URL in one dump the one published later counts.
VERSION = ("datePublished",)
#: Intervals that have ended, by the day that ended them, and those that have not, by bucket.
ENDED, OPEN = "ended", "open"
BUCKETS = 256


def tracked_states(layer: DataFrame) -> DataFrame:
    """The usable rows of the typed layer as states: key, day, version and what is tracked."""
    usable = layer.where((F.col("status") == STATUS_OK) & F.col(KEY).isNotNull())
    return add_difficulty(usable).select(
        KEY,
        EXECUTION_DAY,
        *VERSION,
        "name",
        F.col("total_cook_time").alias("total"),
        F.col("difficulty").alias("level"),
    )


def history_of_layer(spark: SparkSession, layer_path: str) -> DataFrame:
    """The history from all days of the layer at once."""
    states = tracked_states(read_landed(spark, layer_path))
    return validity_history(states, KEY, EXECUTION_DAY, TRACKED, VERSION)


def merge_day(
    spark: SparkSession, layer_path: str, history_path: str, day: dt.date, buckets: int = BUCKETS
) -> None:
    """Carry the history on by the dump of one day, in one step.

    Reads that dump and the open intervals, not the history. Ended intervals are written
    once, in a part of their own, and open ones are rewritten in those buckets that hold a
    change. Days are merged in order; when one is loaded again, merge it and the days
    after it again. A day without usable rows is an error, as it would end everything.
    """
    load = tracked_states(read_days(spark, layer_path, day, day_column=EXECUTION_DAY))
    if load.isEmpty():
        raise ValueError(f"the dump of {day} has no usable rows; the history is left as it is")
    label = str(day)
    base = edition(spark, history_path, before=label)
    buckets = base.facts["buckets"] if base else buckets
    state = F.struct(*TRACKED)
    newest = latest_by_key(load, KEY, VERSION, TRACKED)
    sides = newest.select(F.col(KEY).alias("key"), state.alias("new"))
    if base:
        held = read_parts(spark, history_path, base, OPEN)
        held = held.select(F.col(KEY).alias("key"), F.col(VALID_FROM).alias("since"), state.alias("old"))
        sides = sides.unionByName(held, allowMissingColumns=True)
    else:
        absent = F.lit(None)
        sides = sides.withColumns({"since": absent.cast("date"), "old": absent.cast(sides.schema["new"].dataType)})
    # Each side has a key once: the greatest is the only one there is.
    both = sides.groupBy("key").agg(*[F.max(side).alias(side) for side in ("since", "old", "new")])
    checkpoint_ready(spark)
    both = both.withColumns(
        {"same": F.col("old").eqNullSafe(F.col("new")), "bucket": hash_bucket(F.col("key"), buckets)}
    ).checkpoint()
    touched = [r["bucket"] for r in both.where("not same").select("bucket").distinct().collect()]

    def intervals(rows: DataFrame, side: str, since, until) -> DataFrame:
        return rows.select(
            F.col("key").alias(KEY),
            since.alias(VALID_FROM),
            until.cast("date").alias(VALID_TO),
            *[F.col(f"{side}.{c}").alias(c) for c in TRACKED],
        )

    today, never = F.lit(day), F.lit(None)
    ended = intervals(both.where("not same and old is not null"), "old", F.col("since"), last_valid_day(today))
    since = F.when(F.col("same"), F.col("since")).otherwise(today)
    here = both.where(F.col("bucket").isin(touched) & F.col("new").isNotNull())
    still = intervals(here, "new", since, never)
    made = write_parts(ended, history_path, label, today)
    new = replaced(base, label, ENDED, made, ended.schema, [label], {"buckets": buckets})
    made = write_parts(still, history_path, label, hash_bucket(F.col(KEY), buckets))
    new = replaced(new, label, OPEN, made, still.schema, touched)
    publish(spark, history_path, new)
    log.info("merged %s: %d of %d buckets", day, len(touched), buckets)


def read_history(spark: SparkSession, history_path: str, day: dt.date | None = None) -> DataFrame:
    """All intervals as of the last merged day, or as of the last one up to a day."""
    found = edition(spark, history_path, until=None if day is None else str(day))
    if found is None:
        raise ValueError(f"no history {'yet' if day is None else f'up to {day}'} at {history_path}")
    parts = [read_parts(spark, history_path, found, kind) for kind in (ENDED, OPEN)]
    return parts[0].unionByName(parts[1])


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--layer", required=True)
    parser.add_argument("--history", required=True)
    parser.add_argument("--day", required=True, type=dt.date.fromisoformat)
    options = parser.parse_args(arguments)
    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName("recipe history").getOrCreate()
    merge_day(spark, options.layer, options.history, options.day)


if __name__ == "__main__":
    main()
