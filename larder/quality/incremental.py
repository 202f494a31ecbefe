"""A suite over all days of a dataset, carried on by reading one day.

What a day says about row conditions are counts, which add up over days. Uniqueness
needs the values of other days: a table of keys, each with the number of its rows, is
kept in hash buckets, next to the keys of every day. A day changes the buckets of its
keys, and the buckets' counts of rows and of keys that occur once make the metric. All
of it is one published table, so results are those before a day or after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions import group_key
from larder.quality.constraints import UNIQUE
from larder.quality.suite import RESULTS, Suite, labelled, unique_columns
from larder.sources.published import (
    Edition,
    edition,
    hash_bucket,
    publish,
    read_parts,
    replaced,
    write_parts,
)

#: Keys of one day, by day, and of all days, by bucket.
OF_DAY, OF_ALL = "of_day", "of_all"
BUCKETS = 64


def _key(df: DataFrame, name: str) -> Column:
    """A value as bytes, of bounded length, equal exactly where the values are."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType) and kind.collation != "UTF8_BINARY":
        raise ValueError(f"{name}: text under a collation has no bytes to compare")
    key = group_key(df, name)
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return key
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        key = key + F.lit(0.0)  # there is one zero
    if not isinstance(kind, T.AtomicType):
        raise ValueError(f"{name}: only single values can be unique over days")
    return key.cast("string").cast("binary")


def _keys(df: DataFrame, columns: list[str]) -> DataFrame:
    """``place, key, n``: how often each value of each column occurs; NULL does not count."""
    pairs = [F.struct(F.lit(i).alias("place"), _key(df, c).alias("key")) for i, c in enumerate(columns)]
    rows = df.select(F.inline(F.array(*pairs))).where("key is not null")
    return rows.groupBy("place", "key").agg(F.count(F.lit(1)).alias("n"))


def _measured(df: DataFrame, suite: Suite) -> dict:
    """The number of rows and, by position, of those that meet a row condition; one scan."""
    kinds = {f.name: f.dataType for f in df.schema}
    counts = [
        F.count_if(c.holds(kinds[c.column])).alias(f"n{i}")
        for i, c in enumerate(suite.constraints)
        if c.kind != UNIQUE
    ]
    row = df.agg(F.count(F.lit(1)).alias("n"), *counts).first()
    return {"n": row["n"], **{name: row[name] for name in row.asDict() if name != "n"}}


def check_day(df: DataFrame, suite: Suite, path: str, day: str, buckets: int = BUCKETS) -> None:
    """Take a day's rows into the suite's metrics; a day that was taken in is replaced.

    Reads the rows of the day, its earlier keys if it had any, and the keys of all days
    in the buckets that change. A day may be empty: then it only loses what it had. The
    suite of a table is that of its first day, and another one is refused.
    """
    spark = df.sparkSession
    base = edition(spark, path)
    rules = [c.label for c in suite.constraints]
    if base is not None and base.facts["rules"] != rules:
        raise ValueError(f"{path} was begun with another suite")
    buckets = base.facts["buckets"] if base else buckets
    label = f"{int(base.label) + 1 if base else 0:08d}"
    columns = unique_columns(suite)
    facts = {
        "rules": rules,
        "buckets": buckets,
        "days": {**(base.facts["days"] if base else {}), day: _measured(df, suite)},
        "keys": dict(base.facts["keys"]) if base else {},
    }
    new = base or Edition(label)
    if columns:
        new = _with_keys(_keys(df, columns), path, base, label, day, facts, len(columns))
    publish(spark, path, Edition(label, new.parts, new.schemas, facts))


def _with_keys(
    counted: DataFrame, path: str, base: Edition | None, label: str, day: str, facts: dict, width: int
) -> Edition:
    """The edition with a day's keys taken in; ``facts`` get the counts of the changed buckets."""
    spark = counted.sparkSession
    bucket = hash_bucket(F.struct("place", "key"), facts["buckets"])
    made = write_parts(counted, path, label, F.lit(day))
    staged = replaced(base, label, OF_DAY, made, counted.schema, [day])
    change = read_parts(spark, path, staged, OF_DAY, [day])
    if base is not None and day in base.of(OF_DAY):
        before = read_parts(spark, path, base, OF_DAY, [day])
        change = change.unionByName(before.withColumn("n", -F.col("n")))
        change = change.groupBy("place", "key").agg(F.sum("n").alias("n")).where("n <> 0")
    touched = [r["bucket"] for r in change.select(bucket.alias("bucket")).distinct().collect()]
    both = change
    if base is not None:
        both = both.unionByName(read_parts(spark, path, base, OF_ALL, touched))
    totals = both.groupBy("place", "key").agg(F.sum("n").alias("n")).where("n > 0")
    made = write_parts(totals, path, label, bucket)
    staged = replaced(staged, label, OF_ALL, made, totals.schema, touched)
    for name in touched:
        facts["keys"].pop(name, None)
    # Buckets times unique columns: a number that no data adds to.
    held = read_parts(spark, path, staged, OF_ALL, touched).groupBy(bucket.alias("bucket"), "place")
    for r in held.agg(F.sum("n").alias("n"), F.count_if(F.col("n") == 1).alias("once")).collect():
        facts["keys"].setdefault(r["bucket"], [[0, 0] for _ in range(width)])[r["place"]] = [r["n"], r["once"]]
    return staged


def results(spark: SparkSession, suite: Suite, path: str, check: str | None = None) -> DataFrame:
    """The results over all days taken in, as ``run_suite`` gives them; reads no data."""
    found = edition(spark, path)
    days = list(found.facts["days"].values()) if found else []
    rows = sum(day["n"] for day in days)
    if not rows:
        return spark.createDataFrame([], RESULTS)
    places = {c: i for i, c in enumerate(unique_columns(suite))}
    metrics = []
    for i, c in enumerate(suite.constraints):
        if c.kind == UNIQUE:
            values, once = (sum(held[places[c.column]][k] for held in found.facts["keys"].values()) for k in (0, 1))
            metrics.append((i, once / values if values else None))
        else:
            metrics.append((i, sum(day[f"n{i}"] for day in days) / rows))
    return labelled(spark.createDataFrame(metrics, "ordinal int, metric double"), suite, check)


def days_taken(spark: SparkSession, path: str) -> list[str]:
    found = edition(spark, path)
    return sorted(found.facts["days"]) if found else []
