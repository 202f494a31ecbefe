"""Column profiles: count, mean, median, least and greatest value.

The exact median is found by narrowing. A sketch of the values gives bounds around the
middle; what lies between them is counted, by bins if it is much, and in the bin that
holds the middle by value. A group of any size is profiled without its values ever
meeting in one place.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.sources.workspace import checkpoint_ready

# The sketch's size: a rank it gives is off by an eighth of a percent of the rows, mostly.
# Room for three times that is left on both sides of the middle.
_SKETCH, _ROOM = 4096, 0.004
# So many tasks merge the sketches of all tasks before one merges theirs.
_MEETING = 64
# A range with so many values of a group at most is counted by value.
_BY_VALUE = 4_000_000
# What the first read measures beside the columns that name a group.
_MEASURED = ("n", "total", "nans", "lo", "hi", "sketch")
# Bins between two powers of 2 where a range is endless, and of other ranges in all.
_STEPS = 64
_BINS = 65536
# Above the step of any finite double, whose exponents lie within -1,074 and 1,024.
_LARGEST_STEP = 1100 * _STEPS
# When rows are matched to their group's range, the table of ranges goes to every
# task up to this size, measured before: the group's columns as text and a few
# numbers per group.
_BROADCAST_BYTES = 16 * 2**20
_RANGE_BYTES = 64
# Beyond that rows are shuffled, those of one group over so many partitions. A few
# are enough: the salt keeps the join's partitioning from serving the aggregation
# behind it, and so leaves adaptive execution free to split what is still too big.
_SALTS = 8
# Group columns made here.
_NEVER_NULL = ("place", "salt")


def _values(df: DataFrame, columns: Mapping[int, str], by: Mapping[str, str]) -> DataFrame:
    """One row ``keys, place, value`` per row and profiled column.

    ``columns`` gives the columns by place, ``by`` the grouping columns by the
    key that stands for each of them here, whatever their own names are.
    """
    keys = [F.col(f"`{name}`").alias(key) for key, name in by.items()]
    pairs = [
        F.struct(F.lit(place).alias("place"), F.col(f"`{name}`").cast("double").alias("value"))
        for place, name in columns.items()
    ]
    return df.select(*keys, F.inline(F.array(*pairs)))


def _magnitude_bin(value: Column) -> Column:
    """A number that never falls as the value rises: 64 steps from one power of 2 to the next."""
    size = F.abs(value)
    step = F.when(size == F.lit(float("inf")), F.lit(_LARGEST_STEP)).otherwise(
        F.floor(F.log2(size) * _STEPS)
    )
    return (
        F.when(F.isnan(value), F.lit(3 * _LARGEST_STEP))
        .when(value == 0, F.lit(0))
        .otherwise(F.signum(value) * (step + _LARGEST_STEP + 1))
        .cast("int")
    )


def _sketched(values: DataFrame, group: Sequence[str]) -> DataFrame:
    """One read: count, sum, least, greatest, NaNs and a sketch of the values by group.

    Sketches meet in two steps, so that those of all tasks are not merged by one.
    """
    step = F.pmod(F.spark_partition_id(), F.lit(_MEETING)).alias("step")
    parts = values.groupBy(*group, step).agg(
        F.count("value").alias("n"),
        F.sum("value").alias("total"),
        F.min("value").alias("lo"),
        F.max("value").alias("hi"),
        F.count_if(F.isnan("value")).alias("nans"),
        F.kll_sketch_agg_double("value", _SKETCH).alias("sketch"),
    )
    return parts.groupBy(*group).agg(
        *[F.sum(name).alias(name) for name in ("n", "total", "nans")],
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        F.kll_merge_agg_double("sketch", _SKETCH).alias("sketch"),
    )


def _bracket(first: DataFrame) -> DataFrame:
    """Per group the middle ranks, counted from 0, and values between which they should lie.

    The sketch gives the bounds, with more room than its error needs. Nothing rests on
    them: if a middle rank lies outside, the counts show it and the search goes on there.
    NaN is the greatest value; sketches leave it out.
    """
    n, numbers = F.col("n"), F.col("n") - F.col("nans")
    ranks = {"first_rank": F.floor((n - 1) / 2), "last_rank": F.floor(n / 2)}

    def bound(share: float, end: float) -> Column:
        # The share has to be a constant, and NaNs move the middle: then the range is all numbers.
        at = [F.kll_sketch_get_quantile_double("sketch", F.lit(x)) for x in (share, end)]
        return F.when(numbers == n, at[0]).when(numbers > 0, at[1]).otherwise(F.col("lo"))

    low, high = bound(max(0.0, 0.5 - _ROOM), 0.0), bound(min(1.0, 0.5 + _ROOM), 1.0)
    between = F.when(numbers == n, F.ceil(n * (2 * _ROOM)) + 2).otherwise(n)
    done = (F.col("lo") == F.col("hi")) | (n == 0)
    return first.withColumns(ranks).select(
        *[name for name in first.columns if name not in _MEASURED],
        F.when(done, F.col("lo")).otherwise(low).alias("lo"),
        F.when(done, F.col("hi")).otherwise(high).alias("hi"),
        done.alias("done"),
        *ranks,
        between.alias("held"),
    )


def _narrow(bins: DataFrame, group: Sequence[str]) -> DataFrame:
    """Per group, the range of values that holds the middle ranks.

    ``bins`` has rows ``group, bin, n, lo, hi, first_rank, last_rank``, the
    ranks counted from 0. The range is found (``done``) when it is one value, or
    when the two ranks lie in neighbouring bins and so are the greatest value
    of the one and the least of the other. ``held`` is how many values it has.
    """
    end = F.sum("n").over(Window.partitionBy(*group).orderBy("bin"))
    start = F.col("end") - F.col("n")
    holds = [
        (start <= F.col(rank)) & (F.col(rank) < F.col("end"))
        for rank in ("first_rank", "last_rank")
    ]
    one_bin = F.count(F.lit(1)) == 1
    return (
        bins.withColumn("end", end)
        .where(holds[0] | holds[1])
        .groupBy(*group)
        .agg(
            F.when(one_bin, F.min("lo")).otherwise(F.min("hi")).alias("lo"),
            F.when(one_bin, F.max("hi")).otherwise(F.max("lo")).alias("hi"),
            (~one_bin | (F.min("lo") == F.max("hi"))).alias("done"),
            F.min(F.col("first_rank") - start).alias("first_rank"),
            F.min(F.col("last_rank") - start).alias("last_rank"),
            F.sum("n").alias("held"),
        )
    )


def _match(left: DataFrame, right: DataFrame, group: Sequence[str], how: str) -> DataFrame:
    """Join on the group columns, NULL matching NULL; the left side's are kept."""
    renamed = right.withColumnsRenamed({name: f"__{name}" for name in group})
    same = reduce(
        and_,
        [
            F.col(name) == F.col(f"__{name}")
            if name in _NEVER_NULL
            else F.col(name).eqNullSafe(F.col(f"__{name}"))
            for name in group
        ],
    )
    return left.join(renamed, same, how).drop(*[f"__{name}" for name in group])


def _matched(
    values: DataFrame, wanted: DataFrame, group: Sequence[str], size: int
) -> DataFrame:
    """Values with their group's range and ranks, as ``value, n`` and the range's columns."""
    if size <= _BROADCAST_BYTES:
        weighted = values.withColumn("n", F.lit(1).cast("bigint"))
        return _match(weighted, F.broadcast(wanted), group, "inner")
    # Equal values are counted first and the salt is taken from the value, so
    # neither a hot group nor a hot value within it meets in one task.
    weighted = (
        values.groupBy(*group, "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("salt", F.pmod(F.xxhash64("value"), F.lit(_SALTS)).cast("int"))
    )
    salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt")
    return _match(weighted, wanted.select("*", salts), [*group, "salt"], "inner")


def _refine(
    values: DataFrame,
    state: DataFrame,
    group: Sequence[str],
    size: int,
    outside: bool,
    by_value: bool,
) -> DataFrame:
    """Split the range of each group not done yet into finer bins and narrow again.

    With ``outside`` the ranks are those among all values, so what lies under and over
    the range is counted too; else they are those within it. ``by_value`` makes each
    value a bin of its own, which always finds the middle.
    """
    wanted = state.where(~F.col("done")).drop("done", "held")
    rows = _matched(values.where(F.col("value").isNotNull()), wanted, group, size)
    value, low, high = F.col("value"), F.col("lo"), F.col("hi")
    if by_value:
        fine = value
    else:
        share = F.floor((value - low) / (high - low) * _BINS)
        # Between the greatest numbers of both signs lies more than a double can say.
        endless = high - low == F.lit(float("inf"))
        fine = F.when(endless, _magnitude_bin(value)).otherwise(share).cast("double")
    # NaN is over everything, and a range never ends in it unless it is NaN alone.
    zone = F.when(value < low, -1).when(value > high, F.when(F.isnan(value), 2).otherwise(1)).otherwise(0)
    if not outside:
        rows = rows.where(zone == 0)
    bins = rows.groupBy(
        *group, F.struct(zone.alias("zone"), F.when(zone == 0, fine).alias("fine")).alias("bin")
    ).agg(
        F.sum("n").alias("n"),
        F.min("value").alias("lo"),
        F.max("value").alias("hi"),
        F.min("first_rank").alias("first_rank"),
        F.min("last_rank").alias("last_rank"),
    )
    return state.where(F.col("done")).unionByName(_narrow(bins, group))


def _open_ranges(state: DataFrame, group: Sequence[str]) -> dict[int, tuple[int, int]]:
    """By column with ranges not found yet: their bytes, and the most values in one of them.

    Two numbers per profiled column at most.
    """
    text = [F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0)) for name in group]
    sizes = (
        state.where(~F.col("done"))
        .groupBy("place")
        .agg(F.sum(reduce(add, text) + _RANGE_BYTES).alias("size"), F.max("held").alias("held"))
    )
    return {row["place"]: (row["size"], row["held"]) for row in sizes.collect()}


def column_profile(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), exact_median: bool = True
) -> DataFrame:
    """``by, column, n, mean, median, min, max`` for each numeric column and group.

    With ``exact_median`` this reads the profiled columns once, for the other measures
    and a sketch, and then once or twice for the median before it returns, each read
    leaving a small table in the checkpoint folder. Only where millions of different
    values of a group crowd into a 65,536th of the range around its middle, or a sketch
    was off by more than its bound, does it read again.
    Otherwise it is one lazy pass, and the median is approximate. All values are taken
    as doubles; ``extents`` gives least and greatest values of any type exactly.
    """
    odd = [name for name in columns if not isinstance(df.schema[name].dataType, T.NumericType)]
    if odd:
        raise ValueError(f"no numbers: {odd}; use extents")
    numbered = dict(enumerate(columns))
    keys = {f"__key{i}": name for i, name in enumerate(by)}
    group = [*keys, "place"]
    names = F.array(*[F.lit(name) for name in columns])
    result = [
        *[F.col(key).alias(name) for key, name in keys.items()],
        F.element_at(names, F.col("place") + 1).alias("column"),
        *[F.col(measure) for measure in ("n", "mean", "median", "min", "max")],
    ]
    values = _values(df, numbered, keys)
    if not exact_median:
        return (
            values.groupBy(*group)
            .agg(
                F.count("value").alias("n"),
                F.avg("value").alias("mean"),
                F.percentile_approx("value", 0.5).alias("median"),
                F.min("value").alias("min"),
                F.max("value").alias("max"),
            )
            .select(*result)
        )

    checkpoint_ready(df.sparkSession)
    first = _sketched(values, group).checkpoint()
    state = _bracket(first).checkpoint()
    outside = True
    while open_ranges := _open_ranges(state, group):
        # Only the columns still wanted are read again.
        wanted = _values(df, {place: numbered[place] for place in open_ranges}, keys)
        size = sum(held_bytes for held_bytes, _ in open_ranges.values())
        few = max(held for _, held in open_ranges.values()) <= _BY_VALUE
        state = _refine(wanted, state, group, size, outside, few).checkpoint()
        outside = False

    summary = first.select(
        *group,
        "n",
        F.try_divide("total", "n").alias("mean"),
        F.col("lo").alias("min"),
        F.col("hi").alias("max"),
    )
    medians = state.select(*group, (F.col("lo") * 0.5 + F.col("hi") * 0.5).alias("median"))
    return _match(summary, medians, group, "left").select(*result)


def extents(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``by, column, type, n, least, greatest`` for each column of any type that has an order.

    Least and greatest are found in the column's own type and shown as text, so large
    whole numbers, dates and text stay exact. One lazy pass. NULLs do not count; a
    column without values has neither. An empty table gives one row per column, or
    none with groups.
    """
    keys = [F.col(f"`{name}`").alias(f"__key{i}") for i, name in enumerate(by)]
    places = [F.col(f"`{name}`").alias(f"__value{i}") for i, name in enumerate(columns)]
    group = [f"__key{i}" for i in range(len(by))]
    totals = (
        df.select(*keys, *places)
        .groupBy(*group)
        .agg(
            *[
                measure(f"__value{i}").alias(f"{name}{i}")
                for i in range(len(columns))
                for name, measure in (("n", F.count), ("least", F.min), ("greatest", F.max))
            ]
        )
    )
    rows = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(df.schema[name].dataType.simpleString()).alias("type"),
            F.col(f"n{i}").alias("n"),
            F.col(f"least{i}").cast("string").alias("least"),
            F.col(f"greatest{i}").cast("string").alias("greatest"),
        )
        for i, name in enumerate(columns)
    ]
    flat = totals.select(*group, F.explode(F.array(*rows)).alias("__row"))
    shown = [F.col(key).alias(name) for key, name in zip(group, by, strict=True)]
    return flat.select(*shown, "__row.*")
