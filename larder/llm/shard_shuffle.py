"""A uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

Where each row goes need not be decided row by row: how many rows of a partition go
to each shard is a draw without replacement from the places still free, and any rows
of the partition may be the ones. So every partition puts its rows in random order,
the matrix of counts is drawn exactly, the first rows of the order go to the first
shard and so on, and inside a shard the rows are put in random order once more.
Every assignment of rows to places is equally likely, and shard sizes are exact.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import PLACE_BITS, col, part_starts, placed, stored, without

#: Partitions of the matrix at most; a finer input is merged without a shuffle.
MOST_PARTITIONS = 20_000
ADDED = ["shard", "slot"]


def shard_sizes(rows: int, shards: int) -> np.ndarray:
    """Sizes that add up to the rows and differ by one at most."""
    return rows // shards + (np.arange(shards) < rows % shards)


def drawn(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of the draws without replacement are good ones.

    The generator takes populations below a thousand million; a larger one is met by
    inverting the distribution, walked outwards from its mode.
    """
    if good + bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, draws))
    return walked(rng.random(), good, bad, draws)


def walked(u: float, good: int, bad: int, draws: int) -> int:
    """The draw that belongs to the uniform number, walking outwards from the mode."""
    total = good + bad
    least, most = max(0, draws - bad), min(good, draws)
    mode = min(max((draws + 1) * (good + 1) // (total + 2), least), most)

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    top = math.exp(log_choose(good, mode) + log_choose(bad, draws - mode) - log_choose(total, draws))
    up, down, p_up, p_down = mode, mode, top, top
    u -= top
    while u > 0 and (up < most or down > least):
        if up < most:
            p_up *= (good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1))
            up += 1
            u -= p_up
            if u <= 0:
                return up
        if down > least:
            p_down *= down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1))
            down -= 1
            u -= p_down
            if u <= 0:
                return down
        if p_up < 1e-18 and p_down < 1e-18:
            break
    return mode


def communication_matrix(held: np.ndarray, sizes: np.ndarray, seed: int) -> np.ndarray:
    """How many rows each partition (line) gives to each shard (column).

    Line by line a multivariate hypergeometric draw from the free places of the
    shards, which gives the matrix the law it has under a uniform permutation.
    """
    rng = np.random.default_rng(seed)
    free = [int(size) for size in sizes]
    matrix = np.zeros((len(held), len(free)), np.int64)
    for i, n in enumerate(held):
        left, rest = int(n), sum(free)
        for j, places in enumerate(free):
            rest -= places
            matrix[i, j] = drawn(rng, places, rest, left) if rest else left
            left -= int(matrix[i, j])
        free = [places - int(gone) for places, gone in zip(free, matrix[i], strict=True)]
    return matrix


def shuffled(df: DataFrame, shards: int, seed: int = 1) -> DataFrame:
    """All rows with ``shard`` and ``slot`` (from 0 without gaps) added.

    The order inside partitions and shards follows hashes of the seed and the row's
    number, so a task that runs again makes the same choices. The driver sees one
    count for each partition and draws ``partitions x shards`` numbers.

    NULLs, ties and repeated rows are rows like any other; an empty table gives an
    empty result. Columns named like the two added ones are replaced.
    """
    spark = df.sparkSession
    kept = without(df, ADDED)
    mask = F.lit((1 << PLACE_BITS) - 1)
    number = F.monotonically_increasing_id()
    df = df.coalesce(MOST_PARTITIONS)
    rows = df.select(F.struct(*[col(c) for c in kept]).alias("row"))
    rows = rows.withColumn("number", number).withColumn("order", F.xxhash64(F.lit(seed), "number"))
    local = rows.sortWithinPartitions("order", "number").withColumn("place", number)
    local = stored(
        local.select(
            "row",
            "number",
            F.shiftright("place", PLACE_BITS).cast("int").alias("origin"),
            F.col("place").bitwiseAND(mask).alias("place"),
        ),
        "local",
    )
    counts = {r["origin"]: r["count"] for r in local.groupBy("origin").count().collect()}
    origins = sorted(counts)
    held = np.array([counts[o] for o in origins], np.int64)
    matrix = communication_matrix(held, shard_sizes(int(held.sum()), shards), seed)
    ends = np.cumsum(matrix, 1)
    lines = [(o, line.tolist()) for o, line in zip(origins, ends, strict=True)]
    table = spark.createDataFrame(lines, "origin int, ends array<long>")
    sent = local.join(F.broadcast(table), "origin").withColumn(
        "shard", F.size(F.filter("ends", lambda end: end <= F.col("place")))
    )
    again = F.xxhash64(F.lit(seed + 1), "number")
    in_order = placed(
        sent.select("row", "shard", again.alias("order"), "number"),
        F.col("shard"),
        F.col("order"),
        F.col("number"),
    )
    # A part holds the end of one shard, whole ones and the start of another.
    first = in_order.groupBy("part", "shard").agg(F.min("seq").alias("first"))
    starts = part_starts(in_order, F.lit(1), "shard").join(first, ["part", "shard"])
    numbered = in_order.join(F.broadcast(starts), ["part", "shard"])
    slot = F.col("start") + F.col("seq") - F.col("first")
    return numbered.select("row.*", "shard", slot.alias("slot"))


def write_shards(df: DataFrame, folder: str, shards: int, seed: int = 1) -> None:
    """Write the shuffled rows as one Parquet folder for each shard, in slot order."""
    made = shuffled(df, shards, seed)
    ordered = made.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(folder)
