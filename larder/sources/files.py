"""File scans and the file sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from larder.schemas import CORRUPT_COLUMN, with_corrupt_column


def read_json_lines(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    keep_corrupt: bool = False,
) -> DataFrame:
    """JSON with one object per line, from a file, a folder or several of them.

    With a schema there is no inference pass. ``keep_corrupt`` adds a column
    holding the text of lines that are no JSON object, for the quarantine;
    without it such lines come out as rows of NULLs. Keep uncompressed or
    block-compressed files: a gzip file is read by a single task.
    """
    reader = spark.read.option("multiLine", False).option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(with_corrupt_column(schema) if keep_corrupt else schema)
    return reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN).json(path)


def read_files(
    spark: SparkSession,
    file_format: str,
    path: str | list[str],
    schema: T.StructType | None = None,
    header: bool = True,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Read any built-in file format; ``header`` matters to CSV only.

    ``keep_corrupt`` adds, for JSON and for CSV with a schema, the text of lines that do
    not fit: CSV rows with too many or too few fields or with values of another type.
    Without it such rows are cut, filled up or have NULLs.
    """
    file_format = file_format.lower()
    if file_format == "json":
        return read_json_lines(spark, path, schema, keep_corrupt)
    if keep_corrupt and (file_format != "csv" or schema is None):
        raise ValueError("only JSON, and CSV with a schema, have lines that do not fit")
    reader = spark.read.format(file_format)
    if file_format == "csv":
        # A header that disagrees with the schema is an error, not a silent shift
        # of columns.
        reader = reader.option("header", header).option("enforceSchema", not header)
    if keep_corrupt:
        schema = with_corrupt_column(schema)
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        # A pruned reader does not look at the fields that nobody asked for.
        reader = reader.option("columnPruning", False)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def write_files(
    df: DataFrame,
    path: str,
    file_format: str = "csv",
    header: bool = True,
    single_file: bool = False,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> None:
    """Write a folder of files.

    ``single_file`` is for results already aggregated to a few rows. It adds an
    exchange instead of coalescing, so the stages before it keep their tasks.
    """
    if single_file:
        df = df.repartition(1)
    writer = df.write.mode(mode).format(file_format.lower())
    if file_format.lower() == "csv":
        writer = writer.option("header", header)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.save(path)
