"""An average over the newest version of each thing, kept by a stream.

Every version of a thing is an event. The state, the newest version of each key, is a
published table in hash buckets; a batch reads and rewrites the buckets it touches. Where
a version replaces another one, the old one is taken out of the sum and count of its
group and the new one put in. State and sums are published together under the number of
the batch, so a batch that runs again after a failure finds that it is done.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from larder.operators.compare import _col, _distinct_names
from larder.sources.published import (
    drop_editions,
    edition,
    hash_bucket,
    publish,
    read_parts,
    replaced,
    write_parts,
)
from larder.sources.workspace import checkpoint_ready
from larder.streaming.jobs import _finished, _start, owner_of

NEWEST = "newest"
#: States that stay readable behind the last one.
KEPT_STATES = 4


def _merged(
    spark: SparkSession,
    path: str,
    key: str,
    version: Sequence[str],
    group: str,
    value: str,
    buckets: int,
    checkpoint: str,
) -> Callable[[DataFrame, int], None]:
    names = [f"v{i}" for i in range(len(version))]

    def merge(batch: DataFrame, number: int) -> None:
        label, base = f"{number:012d}", edition(spark, path)
        if base is not None and base.label >= label:
            return  # this batch was published before its stream could note it
        row = F.struct(
            *[_col(c).alias(n) for c, n in zip(version, names, strict=True)],
            _col(group).cast("string").alias("grp"),
            _col(value).cast("decimal(38,0)").alias("amount"),
        )
        fresh = batch.select(_col(key).alias("key"), row.alias("new")).where("key is not null")
        # A key with many versions in a batch sends one row per task.
        fresh = fresh.groupBy("key").agg(F.max("new").alias("new"))
        fresh = fresh.withColumn("bucket", hash_bucket(F.col("key"), buckets)).checkpoint()
        touched = [r["bucket"] for r in fresh.select("bucket").distinct().collect()]
        sums = {} if base is None else {entry["group"]: entry for entry in base.facts["sums"]}
        if base is not None:
            held = read_parts(spark, path, base, NEWEST, touched).select("key", F.col("newest").alias("old"))
            both = fresh.drop("bucket").unionByName(held, allowMissingColumns=True)
        else:
            both = fresh.drop("bucket").withColumn("old", F.lit(None).cast(fresh.schema["new"].dataType))
        both = both.groupBy("key").agg(F.max("old").alias("old"), F.max("new").alias("new"))
        state = both.withColumn("newest", F.greatest("old", "new")).checkpoint()
        changed = state.where(~F.col("old").eqNullSafe(F.col("newest")))
        taken = changed.where("old is not null").select("old.grp", (-F.col("old.amount")).alias("amount"), F.lit(-1).alias("n"))
        put = changed.select("newest.grp", "newest.amount", F.lit(1).alias("n"))
        moved = taken.unionByName(put).where("grp is not null and amount is not null")
        # One row per group; groups come from a fixed list of levels.
        for r in moved.groupBy("grp").agg(F.sum("amount").alias("amount"), F.sum("n").alias("n")).collect():
            entry = sums.get(r["grp"], {"group": r["grp"], "amount": 0, "n": 0})
            sums[r["grp"]] = {"group": r["grp"], "amount": entry["amount"] + int(r["amount"]), "n": entry["n"] + r["n"]}
        rows = state.select("key", "newest")
        made = write_parts(rows, path, label, hash_bucket(F.col("key"), buckets))
        facts = {
            "buckets": buckets,
            "owner": owner_of(spark, checkpoint),
            "sums": [sums[name] for name in sorted(sums) if sums[name]["n"]],
        }
        publish(spark, path, replaced(base, label, NEWEST, made, rows.schema, touched, facts))
        drop_editions(spark, path, KEPT_STATES)

    return merge


def stream_current_average(
    versions: DataFrame,
    path: str,
    checkpoint: str,
    key: str,
    version: Sequence[str],
    group: str = "difficulty",
    value: str = "total_cook_time",
    buckets: int = 64,
    interval: str | None = None,
) -> StreamingQuery:
    """Keep the average of a whole number per group up to date, each key counted once.

    The version of a key that is greatest by ``version``, then by group and value, counts,
    whatever the order of arrival. A newest version without a group, as one that the
    keyword no longer finds, counts nowhere, and neither does one without a value. Rows
    without a key are left out. Sums are exact, so what a version put in is what its
    successor takes out. The number of buckets is that of the table's first batch.

    A table belongs to the stream that began it: with another checkpoint its batches
    would be counted twice, so that is refused.
    """
    _distinct_names(key, *version, group, value)
    spark = versions.sparkSession
    found = edition(spark, path)
    if found is not None:
        buckets = found.facts["buckets"]
        if found.facts["owner"] != owner_of(spark, checkpoint):
            raise ValueError(f"{path} belongs to a stream with another checkpoint")
    checkpoint_ready(spark)
    merge = _merged(spark, path, key, version, group, value, buckets, checkpoint)
    query = _start(versions.writeStream.outputMode("append").foreachBatch(merge), checkpoint, interval)
    return _finished(query, interval)


def current_average(
    spark: SparkSession,
    path: str,
    group: str = "difficulty",
    name: str = "avg_total_cooking_time",
) -> DataFrame:
    """The average per group after the last batch; reads the sums, not the state."""
    found = edition(spark, path)
    sums = found.facts["sums"] if found else []
    rows = [(entry["group"], entry["amount"] / entry["n"]) for entry in sums]
    return spark.createDataFrame(rows, f"`{group}` string, `{name}` double")
