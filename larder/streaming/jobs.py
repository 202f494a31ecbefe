"""Micro-batch jobs over a folder of arriving files.

Each call handles what has arrived since the last one and ends, so a scheduler
can start it periodically; ``interval`` keeps it running instead. Progress,
state and results live under folders the caller names, which have to be
reachable by every executor.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from contextlib import AbstractContextManager, nullcontext

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from larder.operators.recipes import average_by
from larder.schemas import CORRUPT_COLUMN, RECIPE_AGGREGATE, with_corrupt_column
from larder.sources import store
from larder.sources.landing import EXECUTION_DAY, rebalanced
from larder.sources.layer import add_batch
from larder.sources.settings import setting, small_slices


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    file_format: str = "json",
    files_per_batch: int | None = None,
    bytes_per_batch: int | None = None,
    keep_corrupt: bool = False,
) -> DataFrame:
    """A folder as a stream; without a limit a batch takes all files that are there.

    ``keep_corrupt`` keeps the text of JSON lines that cannot be parsed.
    """
    if keep_corrupt:
        schema = with_corrupt_column(schema)
    reader = spark.readStream.format(file_format).schema(schema)
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch is not None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader.load(path)


def _shuffle_partitions(spark: SparkSession, number: int) -> AbstractContextManager[None]:
    """Another number of shuffle partitions for a query started in the block."""
    return setting(spark, "spark.sql.shuffle.partitions", number)


def _start(writer: DataStreamWriter, checkpoint: str, interval: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if interval is not None:
        return writer.trigger(processingTime=interval).start()
    return writer.trigger(availableNow=True).start()


def _finished(query: StreamingQuery, interval: str | None) -> StreamingQuery:
    """Wait for a query that ends by itself; one at an interval is the caller's to stop."""
    if interval is None:
        query.awaitTermination()
    return query


def stream_to_partitions(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str],
    interval: str | None = None,
    rebalance: bool = True,
) -> StreamingQuery:
    """Append arriving rows to partitioned parquet, each row once even after a restart."""
    if rebalance:
        stream = rebalanced(stream, partition_by)
    writer = stream.writeStream.format("parquet").outputMode("append")
    writer = writer.partitionBy(*partition_by).option("path", path)
    with small_slices(stream.sparkSession) if rebalance else nullcontext():
        query = _start(writer, checkpoint, interval)
    return _finished(query, interval)


def stream_to_layer(
    recipes: DataFrame, path: str, checkpoint: str, day: Column, interval: str | None = None
) -> StreamingQuery:
    """Add arriving raw recipes to the typed layer that batch loads publish their days to.

    ``day`` gives the execution day of a row, such as ``arrival_day()``. Each batch is
    seen in one step and once, also when it runs again after a failure; a batch load of a
    day replaces what streams added to it before.
    """

    def write(batch: DataFrame, number: int) -> None:
        add_batch(batch, path, owner_of(spark, checkpoint), number)

    spark = recipes.sparkSession
    dated = recipes.withColumn(EXECUTION_DAY, day.cast("date"))
    query = _start(dated.writeStream.outputMode("append").foreachBatch(write), checkpoint, interval)
    return _finished(query, interval)


def owner_of(spark: SparkSession, checkpoint: str) -> str | None:
    """The number of the query that a checkpoint belongs to; None before its first run."""
    path = f"{checkpoint}/metadata"
    return json.loads(store.read_text(spark, path))["id"] if store.exists(spark, path) else None


def _claimed(spark: SparkSession, path: str, checkpoint: str) -> bool:
    """Whether a result folder is this checkpoint's already; one of another is refused.

    Batches are numbered by checkpoint. Under a new one they begin at 0 and would lose
    to the results of greater numbers that are there.
    """
    note, own = f"{path}/_owner", owner_of(spark, checkpoint)
    if store.exists(spark, note):
        if store.read_text(spark, note) != own:
            raise ValueError(f"{path} belongs to a stream with another checkpoint")
        return True
    if own is None and any(name.startswith("slot=") for name in store.names(spark, path)):
        raise ValueError(f"{path} holds results of another stream")
    return False


#: Folders that hold the results of the last batches; older ones are overwritten.
KEPT_RESULTS = 4


def _write_batch(path: str) -> Callable[[DataFrame, int], None]:
    def write(result: DataFrame, batch: int) -> None:
        # A batch run again after a failure overwrites its own folder; a later one
        # overwrites that of the batch ``KEPT_RESULTS`` before it.
        numbered = result.withColumn("batch", F.lit(batch).cast("long"))
        numbered.write.mode("overwrite").parquet(f"{path}/slot={batch % KEPT_RESULTS}")

    return write


def stream_average(
    labelled: DataFrame,
    path: str,
    checkpoint: str,
    key: str = "difficulty",
    value: str = "total_cook_time",
    name: str = "avg_total_cooking_time",
    interval: str | None = None,
    state_partitions: int = 4,
) -> StreamingQuery:
    """Keep the average per label up to date over all rows seen so far.

    The state is a sum and a count per label. Labels come from a fixed list and
    the result does not depend on time, so there is no watermark and no row is
    ever too late. Every batch leaves the whole result in a folder of its own.

    Rows are added up before the shuffle, so few state partitions are enough for
    any input. The session's number of shuffle partitions is meant for big
    shuffles: each partition, even an empty one, would write its own state files
    in every batch. The number is fixed by the first run on a checkpoint. A result folder
    belongs to the checkpoint that began it, and any other one is refused.
    """
    spark = labelled.sparkSession
    claimed = _claimed(spark, path, checkpoint)
    average = average_by(labelled, key, value, name)
    writer = average.writeStream.outputMode("complete").foreachBatch(_write_batch(path))
    with _shuffle_partitions(spark, state_partitions):
        query = _start(writer, checkpoint, interval)
    if not claimed:
        store.write_new(spark, f"{path}/_owner", query.id)
    return _finished(query, interval)


def latest_average(spark: SparkSession, path: str) -> DataFrame:
    """The result after the last batch; no rows before the first one."""
    try:
        results = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RECIPE_AGGREGATE)
    # One number, out of a fixed number of small folders.
    last = results.agg(F.max("batch")).first()[0]
    return results.where(F.col("batch") == last).drop("batch", "slot")
