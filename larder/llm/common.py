"""Helpers shared by the operators: written tables, global positions, row blocks.

Intermediate tables are Parquet under the folder that ``spark.checkpoint.dir``
names, so that a lost executor costs one task and never a recomputed lineage.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.sources.workspace import fresh_folder

#: ``monotonically_increasing_id`` keeps the place within the partition in these bits.
PLACE_BITS = 33


def col(name: str) -> Column:
    """A column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The same rows, written once to the shared folder and read from there."""
    path = fresh_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The columns that an operator may carry beside its own: on a clash its own wins."""
    taken = {name.lower() for name in names}
    return [name for name in df.columns if name.lower() not in taken]


def row_identity(names: Iterable[str]) -> Column:
    """128 bits of a row's columns as 32 hexadecimal digits; equal rows have equal ones.

    Hashes pass over NULLs, so which columns are NULL is hashed as well.
    """
    columns = [col(name) for name in names]
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in columns])
    halves = [F.xxhash64(nulls, *columns), F.xxhash64(F.lit(1), nulls, *columns)]
    return F.concat(*[F.lpad(F.hex(half), 16, "0") for half in halves])


def placed(df: DataFrame, *by: Column) -> DataFrame:
    """Rows sorted by range, written once, with ``part`` and the place ``seq`` in it.

    Ranges come from a sample of all partitions. Give enough columns to tell rows
    apart, so that a frequent first value is spread over several ranges.
    """
    place = F.monotonically_increasing_id()
    ordered = df.repartitionByRange(*by).sortWithinPartitions(*by)
    mask = (1 << PLACE_BITS) - 1
    return stored(
        ordered.withColumn("part", F.shiftright(place, PLACE_BITS).cast("int")).withColumn(
            "seq", place.bitwiseAND(F.lit(mask))
        ),
        "placed",
    )


def part_starts(table: DataFrame, amount: Column, group: str | None = None) -> DataFrame:
    """For every part the sum of what the parts before it hold, by group if one is given.

    One row for each part (and group that it holds), so its size follows the number
    of partitions and never that of the rows; the window runs over these few rows.
    """
    keys = ["part"] if group is None else ["part", group]
    sums = table.groupBy(*keys).agg(F.sum(amount).cast("long").alias("held"))
    before = Window.orderBy("part") if group is None else Window.partitionBy(group).orderBy("part")
    earlier = F.sum("held").over(before.rowsBetween(Window.unboundedPreceding, -1))
    return sums.select(*keys, F.coalesce(earlier, F.lit(0)).cast("long").alias("start"))


def positions(table: DataFrame, name: str = "position") -> DataFrame:
    """The global position, from 0, of the rows of a placed table; no shuffle of rows."""
    starts = part_starts(table, F.lit(1))
    joined = table.join(F.broadcast(starts), "part")
    return joined.withColumn(name, F.col("start") + F.col("seq")).drop("start", "part", "seq")


def by_batches(
    work: Callable[[pa.RecordBatch], pa.RecordBatch | None], rows: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """An Arrow function over batches of so many rows at most, which bounds the memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                made = work(batch.slice(start, rows))
                if made is not None and made.num_rows:
                    yield made

    return run


def raw_texts(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column."""
    return column.cast(pa.large_binary()).to_pylist()
