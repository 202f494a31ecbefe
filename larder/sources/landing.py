"""The persisted layer: typed, date-partitioned parquet with history by day."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from contextlib import nullcontext

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions import duration_minutes
from larder.operators.quarantine import tag_reason
from larder.sources import store
from larder.sources.files import read_files, read_json_lines
from larder.sources.settings import small_slices

STATUS_OK = "ok"
STATUS_QUARANTINED = "quarantined"
EXECUTION_DAY = "execution_date"


def rebalanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows gathered by partition value before they are written.

    Without an exchange every task would write one small file per partition
    value it sees. The rebalance hint gathers a value's rows, and adaptive
    execution splits a value that holds far more rows than others over several
    tasks, so a hot day neither drowns one writer nor one file. Write the result, or
    start its stream, within ``small_slices``.
    """
    return df.hint("rebalance", *[F.col(name) for name in partition_by])


def land_by_partition(
    df: DataFrame, path: str, partition_by: Sequence[str], rebalance: bool = True
) -> None:
    """Write partitioned parquet; only partitions present in ``df`` are replaced.

    Turn ``rebalance`` off when the input is already laid out by the partition
    columns.
    """
    if rebalance:
        df = rebalanced(df, partition_by)
    with small_slices(df.sparkSession) if rebalance else nullcontext():
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partition_by)
            .parquet(path)
        )


def read_landed(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """Read the landed table; give the schema (with partition columns) to skip inference."""
    return read_files(spark, "parquet", path, schema)


def _has_commit_log(spark: SparkSession, path: str) -> bool:
    """Whether a streaming sink keeps its log of committed files under a path."""
    log = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_spark_metadata")
    return log.getFileSystem(spark._jsc.hadoopConfiguration()).exists(log)


def read_days(
    spark: SparkSession,
    path: str,
    first: dt.date,
    last: dt.date | None = None,
    day_column: str = "event_date",
    schema: T.StructType | None = None,
) -> DataFrame:
    """The rows of one execution day, or of a span of days, both ends included.

    The days' folders are named outright, so the driver lists their files alone
    and not those of the whole history. Days without a folder have no rows. A table
    that a stream writes has a log of the files that count; there that log is read,
    as files of failed attempts may lie in the folders too.
    """
    if _has_commit_log(spark, path):
        day = F.col(day_column)
        return read_landed(spark, path, schema).where(day.between(F.lit(first), F.lit(last or first)))
    span = ((last or first) - first).days + 1
    days = ",".join(str(first + dt.timedelta(days=n)) for n in range(span))
    reader = spark.read.option("basePath", path)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.parquet(f"{path}/{day_column}={{{days}}}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return read_landed(spark, path, schema).where(F.lit(False))


def read_arrival_day(
    spark: SparkSession,
    root: str,
    day: dt.date,
    schema: T.StructType,
    file_format: str = "json",
    keep_corrupt: bool = False,
) -> DataFrame:
    """Raw files of one arrival day, laid out as ``root/yyyy/MM/dd``.

    ``keep_corrupt`` keeps the text of JSON lines that cannot be parsed.
    """
    path = f"{root}/{day:%Y/%m/%d}"
    if file_format == "json":
        return read_json_lines(spark, path, schema, keep_corrupt=keep_corrupt)
    return read_files(spark, file_format, path, schema)


def write_arrivals(df: DataFrame, root: str, day_column: str, file_format: str = "json") -> None:
    """Write raw rows into the folders of their arrival days, ``root/yyyy/MM/dd``.

    One write serves all days: it is partitioned by day beside the layout, and each
    day's folder, one small listing, is moved to its place. A day's earlier arrivals stay.
    """
    spark = df.sparkSession
    beside = f"{root}/_arriving-{uuid.uuid4().hex}"
    marked = rebalanced(df.where(F.col(day_column).isNotNull()), [day_column])
    with small_slices(spark):
        marked.write.partitionBy(day_column).format(file_format).save(beside)
    prefix = f"{day_column}="
    for name in store.names(spark, beside):
        if name.startswith(prefix):
            target = f"{root}/{dt.date.fromisoformat(name.removeprefix(prefix)):%Y/%m/%d}"
            store.move_files(spark, f"{beside}/{name}", target)
    store.delete(spark, beside)


# Text columns whose outer blanks carry no meaning.
RECIPE_TEXT = ("name", "url", "image", "recipeYield", "description")


def type_recipes(recipes: DataFrame) -> DataFrame:
    """Trim the text, type the date and the durations, and tag rows that cannot be used."""
    published = F.col("datePublished").try_cast("date")
    return tag_reason(recipes).withColumns(
        {
            **{name: F.trim(name) for name in RECIPE_TEXT},
            "datePublished": published,
            "prepTimeMinutes": duration_minutes("prepTime"),
            "cookTimeMinutes": duration_minutes("cookTime"),
            "published_year": F.year(published),
        }
    ).withColumn(
        "status", F.when(F.col("reason").isNull(), STATUS_OK).otherwise(STATUS_QUARANTINED)
    )


def preprocess_recipes(recipes: DataFrame, path: str, day: dt.date | None = None) -> None:
    """Persist raw recipes as typed parquet by execution day, good and bad rows together.

    A load replaces the rows of its own day and no others, so loading a day again
    after rows were mended leaves no stale row, and later days keep earlier ones. Loads
    without a day share one partition, which each of them replaces. The status is an
    ordinary column, and the raw text is parsed once however many jobs read the result.
    """
    if recipes.isEmpty():
        raise ValueError("the load has no rows; the layer is left as it is")
    dated = type_recipes(recipes).withColumn(EXECUTION_DAY, F.lit(day).cast("date"))
    land_by_partition(dated, path, [EXECUTION_DAY])
