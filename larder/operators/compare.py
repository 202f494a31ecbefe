"""Comparing two datasets (reconciliation, change tracking) and bringing changes up to date.

By key, the two sides go into one union that is grouped once, instead of being
joined. That is one shuffle for both, rows are counted before it, NULL keys need
no special care, and a key with many rows on both sides never forms pairs.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import group_key
from larder.sources.workspace import checkpoint_ready

_SIDE = "__side"


def _col(name: str) -> Column:
    """A column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def _distinct_names(*names: str) -> None:
    """Refuse a result in which two columns would have one name."""
    lower = [name.lower() for name in names]
    twice = sorted({name for name in names if lower.count(name.lower()) > 1})
    if twice:
        raise ValueError(f"rename the columns: the result would have several called {twice}")


def _tagged(first: DataFrame, second: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Both sides' columns under each other as c0, c1, ..., tagged 1 and 2."""
    named = [_col(c).alias(f"c{i}") for i, c in enumerate(columns)]
    return (
        first.select(*named, F.lit(1).alias(_SIDE))
        .unionByName(second.select(*named, F.lit(2).alias(_SIDE)))
    )


def _places(start: int, columns: Sequence[str]) -> list[str]:
    """What ``_tagged`` calls these columns, from a place on."""
    return [f"c{start + i}" for i in range(len(columns))]


def _renamed(places: Sequence[str], names: Sequence[str]) -> list[Column]:
    return [F.col(place).alias(name) for place, name in zip(places, names, strict=True)]


def _of_side(side: int, value: Column) -> Column:
    return F.when(F.col(_SIDE) == side, value)


def reconcile(
    source: DataFrame, target: DataFrame, keys: Sequence[str], sums: Sequence[str] = ()
) -> DataFrame:
    """Row counts and column sums per key on both sides, and whether they agree.

    Gives ``source_rows, target_rows, source_<c>, target_<c>, status``, the
    status being ``match``, ``mismatch``, ``missing in target`` or ``missing in
    source``. Use exact types for the sums: doubles added in another order may
    differ in their last digit.
    """
    measured = [f"{prefix}_{c}" for prefix in ("source", "target") for c in ("rows", *sums)]
    _distinct_names(*keys, *measured, "status")
    both = _tagged(source, target, [*keys, *sums])
    by, summed = _places(0, keys), _places(len(keys), sums)
    totals = []
    for side in (1, 2):
        totals.append(F.count(_of_side(side, F.lit(1))).alias(f"rows{side}"))
        totals.extend(F.sum(_of_side(side, F.col(c))).alias(f"{c}_{side}") for c in summed)
    agree = reduce(
        and_,
        [F.col(f"{c}_1").eqNullSafe(F.col(f"{c}_2")) for c in summed],
        F.col("rows1") == F.col("rows2"),
    )
    status = (
        F.when(F.col("rows2") == 0, "missing in target")
        .when(F.col("rows1") == 0, "missing in source")
        .when(agree, "match")
        .otherwise("mismatch")
    )
    made = [name for side in (1, 2) for name in (f"rows{side}", *[f"{c}_{side}" for c in summed])]
    return both.groupBy(*by).agg(*totals).select(
        *_renamed([*by, *made], [*keys, *measured]), status.alias("status")
    )


def reconcile_rows(
    source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Whole-content comparison: keys and counts of rows not equally often on both sides.

    Rows are equal when the keys and all the columns are. Long text takes part
    as a digest, so no content travels.
    """
    _distinct_names(*keys, "source_rows", "target_rows")
    contents = [f"__content{i}" for i in range(len(columns))]
    sides = [
        side.select(
            *[_col(k).alias(f"__key{i}") for i, k in enumerate(keys)],
            *[group_key(side, c).alias(k) for c, k in zip(columns, contents, strict=True)],
        )
        for side in (source, target)
    ]
    both = _tagged(*sides, sides[0].columns)
    counts = both.groupBy(*_places(0, sides[0].columns)).agg(
        F.count(_of_side(1, F.lit(1))).alias("source_rows"),
        F.count(_of_side(2, F.lit(1))).alias("target_rows"),
    )
    differing = counts.where(F.col("source_rows") != F.col("target_rows"))
    return differing.select(*_renamed(_places(0, keys), keys), "source_rows", "target_rows")


#: Buckets of the first comparison, and those that each differing one is split into.
_DIGEST_BUCKETS, _SPLIT = 1024, 1024


def _contents(side: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Each row's keys, contents and two hashes of them; the first deals it into buckets."""
    rows = side.select(
        *[_col(k).alias(f"k{i}") for i, k in enumerate(keys)],
        *[group_key(side, c).alias(f"v{i}") for i, c in enumerate(columns)],
    )
    # A hash of columns passes over NULLs, so which ones are NULL is hashed as well.
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in rows.columns])
    return rows.withColumns(
        {"hash": F.xxhash64(nulls, *rows.columns), "proof": F.xxhash64(*rows.columns, nulls, F.lit(7))}
    )


def _differing(first: DataFrame, second: DataFrame, bucket: Column) -> DataFrame:
    """The buckets whose rows differ between two sides, by checksums that know no order.

    Each side's task sends a row for each bucket: its count, and sums and exclusive-ors
    of two hashes of its rows.
    """
    sides = []
    for sign, side in ((1, first), (-1, second)):
        sides.append(
            side.select(
                bucket.alias("bucket"),
                F.lit(sign).alias("n"),
                *[F.col(h).cast("decimal(20,0)").alias(h) for h in ("hash", "proof")],
                F.col("hash").alias("x"),
                F.col("proof").alias("y"),
            )
        )
    both = sides[0].unionByName(sides[1])
    totals = both.groupBy("bucket").agg(
        F.sum("n").alias("n"),
        *[F.sum(F.col("n") * F.col(h)).alias(h) for h in ("hash", "proof")],
        *[F.bit_xor(h).alias(h) for h in ("x", "y")],
    )
    return totals.where("n <> 0 or hash <> 0 or proof <> 0 or x <> 0 or y <> 0").select("bucket")


def reconcile_by_digest(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    buckets: int = _DIGEST_BUCKETS,
    split: int = _SPLIT,
) -> DataFrame:
    """What ``reconcile_rows`` gives, for sides that should be equal.

    Rows fall into hash buckets, of which only checksums move. Buckets that differ are
    split again, and only rows in parts that differ are shuffled and compared whole, so
    equal sides shuffle one row per bucket and task. Up to three scans of both sides. Where
    most buckets differ the second comparison is left out, as it would spare nothing. A
    bucket counts as equal if its number of rows and four checksums of 64 bits are.
    """
    _distinct_names(*keys, "source_rows", "target_rows")
    checkpoint_ready(source.sparkSession)
    sides = [_contents(side, keys, columns) for side in (source, target)]
    first = F.pmod(F.col("hash"), F.lit(buckets))
    wrong = _differing(*sides, first).checkpoint()
    n = wrong.count()
    if 2 * n <= buckets:
        # The buckets' number bounds what is sent: at most this many pairs of numbers.
        rest = [s.withColumn("bucket", first).join(F.broadcast(wrong), "bucket", "left_semi") for s in sides]
        finer = F.pmod(F.shiftright("hash", 20) + F.col("bucket"), F.lit(split))
        finer = F.col("bucket") * split + finer
        if n:
            parts = _differing(*rest, finer).checkpoint()
            sides = [s.withColumn("part", finer).join(parts.withColumnRenamed("bucket", "part"), "part", "left_semi") for s in rest]
        else:
            sides = [s.where(F.lit(False)) for s in rest]
    named = [*[f"k{i}" for i in range(len(keys))], *[f"v{i}" for i in range(len(columns))]]
    both = _tagged(*[s.select(*named) for s in sides], named)
    counts = both.groupBy(*_places(0, named)).agg(
        F.count(_of_side(1, F.lit(1))).alias("source_rows"),
        F.count(_of_side(2, F.lit(1))).alias("target_rows"),
    )
    differing = counts.where(F.col("source_rows") != F.col("target_rows"))
    return differing.select(*_renamed(_places(0, keys), keys), "source_rows", "target_rows")


_MEASURES = {"filled": F.count, "least": F.min, "greatest": F.max}


def _column_summary(df: DataFrame, prefix: str) -> DataFrame:
    """One row per column: its type and, as text, its measures. One pass, one aggregate row."""
    totals = df.agg(
        *[
            measure(_col(name)).cast("string").alias(f"{m}{i}")
            for i, name in enumerate(df.columns)
            for m, measure in _MEASURES.items()
        ]
    )
    rows = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(kind).alias(f"{prefix}_type"),
            *[F.col(f"{m}{i}").alias(f"{prefix}_{m}") for m in _MEASURES],
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return totals.select(F.inline(F.array(*rows)))


def reconcile_columns(source: DataFrame, target: DataFrame) -> DataFrame:
    """Column by column: type, number of values, least and greatest value on both sides.

    Gives ``column`` and, per side, ``<side>_type, <side>_filled, <side>_least,
    <side>_greatest`` with a status as in ``reconcile``. What is joined here is
    one row per column.
    """
    agree = reduce(
        and_, [F.col(f"source_{m}").eqNullSafe(F.col(f"target_{m}")) for m in ("type", *_MEASURES)]
    )
    status = (
        F.when(F.col("target_type").isNull(), "missing in target")
        .when(F.col("source_type").isNull(), "missing in source")
        .when(agree, "match")
        .otherwise("mismatch")
    )
    return (
        _column_summary(source, "source")
        .join(_column_summary(target, "target"), "column", "full_outer")
        .withColumn("status", status)
    )


def snapshot_changes(
    before: DataFrame,
    after: DataFrame,
    key: str,
    tracked: Sequence[str],
    version: Sequence[str] = (),
    many_rows: bool = False,
) -> DataFrame:
    """Keys added, removed or changed between two snapshots, with old and new values.

    A key should occur once per snapshot. Where it occurs more often, its row
    greatest by ``version``, then by the tracked values, stands for it, and
    ``snapshot_duplicates`` names it.

    Rows are sorted once, after the shuffle, because an aggregation before it saves
    nothing where keys occur once. ``many_rows`` adds that aggregation, for snapshots
    in which a key can hold many rows; the result is the same.
    """
    shown = [f"{side}_{c}" for c in tracked for side in ("old", "new")]
    _distinct_names(key, "change", *shown)
    both = _tagged(before, after, [key, *version, *tracked])
    values = _places(1 + len(version), tracked)
    row = F.struct(*_places(1, version), *values)
    gathered = both if many_rows else both.repartition("c0")
    latest = gathered.groupBy("c0").agg(
        F.max(_of_side(1, row)).alias("old"), F.max(_of_side(2, row)).alias("new")
    )

    def state(side: str) -> Column:
        return F.struct(*[F.col(f"{side}.{c}") for c in values])

    change = (
        F.when(F.col("old").isNull(), "added")
        .when(F.col("new").isNull(), "removed")
        .when(~state("old").eqNullSafe(state("new")), "changed")
    )
    sides = [F.col(f"{side}.{c}") for c in values for side in ("old", "new")]
    return latest.where(change.isNotNull()).select(
        F.col("c0").alias(key),
        change.alias("change"),
        *[side.alias(name) for side, name in zip(sides, shown, strict=True)],
    )


def snapshot_duplicates(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once in a snapshot: ``key, old_rows, new_rows``.

    Rows are counted before the shuffle, so a key with many rows is no hot spot.
    """
    _distinct_names(key, "old_rows", "new_rows")
    counts = _tagged(before, after, [key]).groupBy("c0").agg(
        F.count(_of_side(1, F.lit(1))).alias("old_rows"),
        F.count(_of_side(2, F.lit(1))).alias("new_rows"),
    )
    often = counts.where((F.col("old_rows") > 1) | (F.col("new_rows") > 1))
    return often.select(F.col("c0").alias(key), "old_rows", "new_rows")


def latest_by_key(
    df: DataFrame, key: str, version: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """The current state of things whose every change is a row: per key the newest row.

    Newest is the greatest by ``version``, then by the columns themselves, so the
    result does not depend on the order of the rows. One shuffle, after each task
    has kept the newest row of its own per key, so that a key with a great many
    changes sends one row per task.
    """
    kept = [*version, *columns]
    _distinct_names(key, *kept)
    numbered = _places(1, kept)
    slim = df.select(*[_col(c).alias(p) for c, p in zip([key, *kept], ["c0", *numbered], strict=True)])
    newest = slim.groupBy("c0").agg(F.max(F.struct(*numbered)).alias("newest"))
    return newest.select(
        F.col("c0").alias(key),
        *[F.col(f"newest.{place}").alias(c) for place, c in zip(numbered, kept, strict=True)],
    )
