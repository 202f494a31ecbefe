"""The typed layer as a published table, written by batch loads and by streams alike.

A day's rows are the part that a batch load published for it and the parts that batches
of a stream added since. Each load is seen in one step, after its checks.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.sources.landing import EXECUTION_DAY, type_recipes
from larder.sources.published import Edition, edition, publish, read_parts, replaced, write_parts

ROWS = "rows"
#: Between the day of a part and the number of the streamed batch that added it.
ADDED = "~"


def _day_of(part: str) -> str:
    return part.partition(ADDED)[0]


def _next_label(base: Edition | None) -> str:
    return f"{int(base.label) + 1 if base else 0:08d}"


def publish_day(
    recipes: DataFrame,
    path: str,
    day: dt.date,
    check: Callable[[DataFrame], None] | None = None,
) -> None:
    """Load raw recipes as the typed rows of a day, replacing that day's rows in one step.

    The rows are written beside the table first. ``check`` gets them as they were written
    and raises if they are not to be seen; the table is then left as it is, as it is when
    the load dies at any point. Whoever reads meanwhile sees the day before the load or
    after it. Good and bad rows are both kept, as in ``preprocess_recipes``; a load
    without rows is an error.
    """
    spark = recipes.sparkSession
    typed = type_recipes(recipes).withColumn(EXECUTION_DAY, F.lit(day).cast("date"))
    base = edition(spark, path)
    label = _next_label(base)
    made = write_parts(typed, path, label, F.lit(str(day)))
    if not made:
        raise ValueError("the load has no rows; the layer is left as it is")
    before = [part for part in (base.of(ROWS) if base else ()) if _day_of(part) == str(day)]
    new = replaced(base, label, ROWS, made, typed.schema, before)
    if check is not None:
        check(read_parts(spark, path, new, ROWS, [str(day)]))
    publish(spark, path, new)


def read_layer(
    spark: SparkSession, path: str, first: dt.date | None = None, last: dt.date | None = None
) -> DataFrame:
    """The rows of all days, of one day, or of a span of days, both ends included.

    Only the files of these days are listed and read, and all of them as one edition
    names them.
    """
    found = edition(spark, path)
    if found is None:
        raise ValueError(f"no day was published at {path}")
    parts = list(found.of(ROWS))
    if first is not None:
        parts = [part for part in parts if str(first) <= _day_of(part) <= str(last or first)]
    return read_parts(spark, path, found, ROWS, parts)


def add_batch(recipes: DataFrame, path: str, stream: str, number: int) -> None:
    """Add the raw recipes of a stream's batch to their days, in one step and once.

    Rows come with their execution day; those without one go to the day NULL, which
    spans of days leave out. A batch that this stream has added already is not added again.
    """
    spark = recipes.sparkSession
    base = edition(spark, path)
    done = dict(base.facts.get("streams", {})) if base else {}
    if done.get(stream, -1) >= number:
        return
    label = _next_label(base)
    typed = type_recipes(recipes)
    part = F.concat(F.coalesce(F.col(EXECUTION_DAY).cast("string"), F.lit("NULL")), F.lit(f"{ADDED}{stream}-{number}"))
    made = write_parts(typed, path, label, part)
    facts = {**(base.facts if base else {}), "streams": {**done, stream: number}}
    publish(spark, path, replaced(base, label, ROWS, made, typed.schema, (), facts))


def arrival_day() -> Column:
    """The day of the folder ``yyyy/MM/dd`` that a row's file lies in."""
    folder = F.regexp_extract("_metadata.file_path", "/([0-9]{4}/[0-9]{2}/[0-9]{2})/[^/]*$", 1)
    return F.try_to_timestamp(folder, F.lit("yyyy/MM/dd")).cast("date")
