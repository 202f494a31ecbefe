"""Tables laid out to find rows by key: ranges of the key, and Bloom filters on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.sources.files import read_files

#: A look-up reads at least one group of this size, and keeps its Bloom filter in the file.
GROUP_BYTES = 8 << 20
#: Different keys that a group's filter is made for; more of them make it miss less.
GROUP_KEYS = 100_000


def write_for_lookup(
    df: DataFrame,
    path: str,
    key: str,
    files: int | None = None,
    group_bytes: int = GROUP_BYTES,
    group_keys: int = GROUP_KEYS,
) -> None:
    """Write rows sorted by ranges of a key, with a Bloom filter on it for each row group.

    Files hold neighbouring ranges, so the least and greatest key in a file's footer leave
    few files to a look-up, and the filter tells most keys that lie in a group's range and
    are not there. Rows of a key that has very many are dealt over several files by a hash
    of their other columns. NULL keys are kept, in the first file.
    """
    column = F.col(f"`{key}`")
    others = [F.col(f"`{name}`") for name in df.columns if name != key]
    others = [c for c in others if not isinstance(df.select(c).schema[0].dataType, (T.MapType, T.VariantType))]
    spread = F.xxhash64(*others) if others else F.lit(0)
    ordered = df.repartitionByRange(*([files] if files else []), column, spread).sortWithinPartitions(column)
    (
        ordered.write.mode("overwrite")
        .option("parquet.block.size", group_bytes)
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{key}", group_keys)
        .parquet(path)
    )


def lookup(
    spark: SparkSession, path: str, key: str, values: Sequence, schema: T.StructType | None = None
) -> DataFrame:
    """The rows of some keys; the keys are part of the plan, so take few of them.

    They reach the scan as a filter, which leaves out files and row groups by their
    ranges and filters. For many keys join with a table of them.
    """
    table = read_files(spark, "parquet", path, schema)
    return table.where(F.col(f"`{key}`").isin(list(values)))
