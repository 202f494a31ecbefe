"""How long each state of a thing held, from the states that were seen day by day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.operators.compare import _col, _distinct_names, _places

VALID_FROM, VALID_TO = "valid_from", "valid_to"


def last_valid_day(next_load: Column) -> Column:
    """The day before the load that no longer had a state; NULL while there is none."""
    return F.date_sub(next_load, 1)


def validity_history(
    states: DataFrame,
    key: str,
    day: str,
    columns: Sequence[str],
    version: Sequence[str] = (),
) -> DataFrame:
    """``key, valid_from, valid_to`` and the columns: the intervals over which they held.

    Each day's rows are a whole dump: a key that is missing on a day with rows is gone that
    day. An interval spans neighbouring loads in which the key has equal columns, NULL
    equal to NULL. It ends, both ends included, on the day before the first load that
    shows otherwise, and has no end if the last load still shows it. Days without any
    row are no loads and end nothing. Rows without a key or a day are left out. Where a
    day has several rows of a key, the one greatest by ``version``, then by the columns,
    counts; they are reduced before the shuffle, so a key with many rows a day is no hot
    spot, and what follows has at most one row for each key and day.
    """
    _distinct_names(key, VALID_FROM, VALID_TO, *columns)
    kept = [*version, *columns]
    numbered = _places(1, kept)
    slim = states.select(
        _col(key).alias("c0"),
        _col(day).cast("date").alias("day"),
        *[_col(c).alias(p) for c, p in zip(kept, numbered, strict=True)],
    ).where("c0 is not null and day is not null")
    newest = slim.groupBy("c0", "day").agg(F.max(F.struct(*numbered)).alias("newest"))
    state = F.struct(*[F.col(f"newest.{p}").alias(p) for p in numbered[len(version) :]])

    # One row per loaded day: a date has fewer than four million values, whatever the input.
    in_order = Window.orderBy("day")
    loads = slim.select("day").distinct().select(
        "day",
        F.row_number().over(in_order).alias("load"),
        F.lead("day").over(in_order).alias("next_load"),
    )
    rows = newest.select("c0", "day", state.alias("state")).join(F.broadcast(loads), "day")
    of_key = Window.partitionBy("c0").orderBy("load")
    before = F.lag("load").over(of_key)
    goes_on = (before == F.col("load") - 1) & F.lag("state").over(of_key).eqNullSafe(F.col("state"))
    starts = F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)
    marked = rows.withColumn("starts", starts).withColumn("island", F.sum("starts").over(of_key))
    spans = marked.groupBy("c0", "island").agg(
        F.min("day").alias(VALID_FROM),
        F.max(F.struct("load", "next_load")).alias("last"),
        F.first("state").alias("state"),
    )
    return spans.select(
        F.col("c0").alias(key),
        VALID_FROM,
        last_valid_day(F.col("last.next_load")).alias(VALID_TO),
        *[F.col(f"state.{p}").alias(c) for p, c in zip(numbered[len(version) :], columns, strict=True)],
    )
