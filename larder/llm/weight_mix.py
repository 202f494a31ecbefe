"""Mixing sources to target weights by Pfair scheduling, with DataFrame functions only.

Each source's documents are cut into blocks of about equal size. With weight w the
k-th block of a source (from 0) is released at slot floor(k / w) and due by slot
ceil((k + 1) / w), and every slot goes to the released block that is due first. The
weights add up to one, so no block is late, and after any slot each source has had
within one block of its share.

Weights are whole numbers out of their sum, so releases and deadlines are exact at any
length. The schedule is a fold over the slots whose state is one counter for each source;
it runs in pieces, each a job whose state is written for the next one. Only slots and
counters pass through it, never documents. Its cost is slots times sources, so block
sizes grow once the corpus has more than MOST_SLOTS blocks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import col, part_starts, placed, row_identity, stored, without
from larder.sources.workspace import fresh_folder

#: Target weights are rounded to one part in this.
SCALE = 1 << 30
#: Slots of an inner fold, and inner folds of a job.
RUN, RUNS = 1024, 64
#: Blocks of a corpus, beyond which blocks hold more than they were asked to.
MOST_SLOTS = 1 << 20
ADDED = ["mix_source", "mix_block", "mix_epoch", "mix_slot", "mix_place"]


def _div(a: Column, b: Column) -> Column:
    """Division of whole numbers, exact where doubles are not."""
    return F.call_function("div", a, b)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """A column made from a value that is computed once, however often the column names it."""
    return F.transform(F.array(value), body)[0]


def _window_of(k: Column, weight: Column, total: Column) -> tuple[Column, Column]:
    """The slot a block is released at, and the one it is due by."""
    return _div(k * total, weight), _div((k + 1) * total + weight - 1, weight)


def schedule(sources: DataFrame, slots: int) -> DataFrame:
    """``name``, ``mix_block`` and ``mix_slot`` of so many slots, earliest deadline first.

    ``sources`` has ``name`` and ``weight``, a whole number above zero; a source's share
    is its weight out of the sum. Ties go to the first name.
    """
    spark = sources.sparkSession
    folder = fresh_folder(spark, "schedule")
    every = F.sort_array(F.collect_list(F.struct("name", "weight")))
    first = sources.agg(every.alias("sources"), F.sum("weight").alias("total"))

    def entry(k: Column, source: Column) -> Column:
        weight = F.element_at("sources", (source + 1).cast("int"))["weight"]
        release, due = _window_of(k, weight, F.col("total"))
        return F.struct(release.alias("release"), due.alias("due"), source.cast("int").alias("source"), k.alias("k"))

    def step(state: Column, slot: Column) -> Column:
        ready = F.transform(
            state["next"], lambda e: F.struct((e["release"] > slot).alias("early"), e["due"], e["source"], e["k"])
        )

        def taken(chosen: Column) -> Column:
            after = entry(chosen["k"] + 1, chosen["source"])
            following = F.transform(state["next"], lambda e: F.when(e["source"] == chosen["source"], after).otherwise(e))
            made = F.struct(chosen["source"].alias("source"), chosen["k"].alias("k"))
            return F.struct(following.alias("next"), F.concat(state["out"], F.array(made)).alias("out"))

        return _let(F.array_min(ready), taken)

    def run(state: Column, start: Column) -> Column:
        none = F.array().cast("array<struct<source:int,k:bigint>>")
        inner = F.sequence(start, F.least(start + RUN, F.lit(slots).cast("long")) - 1)
        done = F.aggregate(inner, F.struct(state["next"].alias("next"), none.alias("out")), step)

        def added(one: Column) -> Column:
            return F.struct(one["next"].alias("next"), F.concat(state["runs"], F.array(one["out"])).alias("runs"))

        return _let(done, added)

    numbers = F.sequence(F.lit(0), F.size("sources") - 1)
    state = first.withColumn("next", F.transform(numbers, lambda i: entry(F.lit(0).cast("long"), i)))
    for at in range(0, slots, RUN * RUNS):
        end = min(at + RUN * RUNS, slots)
        starts = F.sequence(F.lit(at).cast("long"), F.lit(end - 1).cast("long"), F.lit(RUN).cast("long"))
        none = F.array().cast("array<array<struct<source:int,k:bigint>>>")
        folded = F.aggregate(starts, F.struct(F.col("next").alias("next"), none.alias("runs")), run)
        done = stored(state.select("sources", "total", folded.alias("done")), "schedule-state")
        rows = done.select("sources", F.posexplode(F.flatten("done.runs")).alias("place", "made"))
        rows.select(
            F.element_at("sources", F.col("made.source") + 1)["name"].alias("name"),
            F.col("made.k").alias("mix_block"),
            (F.col("place") + F.lit(at).cast("long")).alias("mix_slot"),
        ).write.parquet(f"{folder}/piece={at}")
        state = done.select("sources", "total", "done.next")
    shape = "name string, mix_block long, mix_slot long"
    if not slots:
        return spark.range(0).selectExpr("'' as name", "id as mix_block", "id as mix_slot")
    return spark.read.schema(shape + ", piece long").parquet(folder).drop("piece")


def _window(part: str, order: str):
    from pyspark.sql import Window

    return Window.partitionBy(part).orderBy(order)


def tempered_weights(df: DataFrame, source: str, power: float) -> DataFrame:
    """``name`` and ``weight``, in proportion to a power of a source's rows; below one, small ones gain."""
    named = df.select(col(source).cast("string").alias("name")).where("name is not null")
    counts = named.groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("name", F.pow(F.col("n").cast("double"), F.lit(float(power))).alias("weight"))


def as_table(spark: SparkSession, weights: dict[str, float] | DataFrame) -> DataFrame:
    """Weights as a table ``name, weight`` of those above zero."""
    if isinstance(weights, dict):
        pairs = F.create_map(*[F.lit(x) for name, w in weights.items() for x in (name, float(w))])
        none = spark.range(0).selectExpr("'' as name", "0D as weight")
        weights = spark.range(1).select(F.explode(pairs).alias("name", "weight")) if weights else none
    return weights.select(F.col("name").cast("string"), F.col("weight").cast("double")).where(
        "name is not null and weight > 0 and weight < double('infinity')"
    )


def mixed(
    df: DataFrame,
    weights: dict[str, float] | DataFrame,
    source: str = "source",
    size: Column | None = None,
    block: int = 64,
    repeat: bool = True,
    rest: str = "(rest)",
    rest_weight: float = 0.01,
    seed: int = 3,
) -> DataFrame:
    """All rows in a mix of the target weights, with where each belongs.

    ``mix_slot`` is the block's slot and ``mix_place`` the row's place in the block;
    sorting by both gives the mix. ``mix_source``, ``mix_block`` and ``mix_epoch`` tell
    the source, the block's number over all epochs and how often the source had
    been used up before. A block holds ``block`` units of ``size`` (rows, if NULL), or more
    where the rows would make more than MOST_SLOTS of them, and a row belongs to the
    block in which it begins; each source is in random order. ``weights`` are given by
    name, or as a table ``name, weight``; there may be any number of sources.

    With ``repeat`` the mix ends when the last source has been used up for the first
    time, and sources used up earlier start again, so every row occurs at least once
    and the weights hold to the end. Without it, every row occurs once and a
    source that is used up simply ends.

    NULL sources and sources without a weight are one source of their own, ``rest``,
    with the share ``rest_weight`` if any such row occurs. A NULL or negative size
    counts as zero. Repeated rows are rows of their own; an empty table gives an
    empty result. Columns named like the added ones are replaced.
    """
    spark = df.sparkSession
    kept = without(df, ADDED)
    wanted = stored(as_table(spark, weights), "weights")
    rows = df.select(
        F.struct(*[col(c) for c in kept]).alias("row"),
        col(source).cast("string").alias("name"),
        F.greatest(F.coalesce(F.lit(1) if size is None else size, F.lit(0)), F.lit(0))
        .cast("long")
        .alias("size"),
    )
    known = wanted.select(F.col("name").alias("known"))
    rows = rows.join(known, F.col("name") == F.col("known"), "left")
    rows = rows.withColumn("name", F.coalesce("known", F.lit(rest))).drop("known")
    rows = rows.withColumn("order", F.xxhash64(F.lit(seed), "row"))
    rows = rows.withColumn("order2", F.xxhash64(F.lit(seed + 1), "row"))
    table = placed(rows, F.col("name"), F.col("order"), F.col("order2"))
    starts = part_starts(table, F.col("size"), "name")
    firsts = part_starts(table, F.lit(1), "name").withColumnRenamed("start", "first")
    running = _window("part", "seq").partitionBy("part", "name")
    table = table.withColumn("inner", F.sum("size").over(running) - F.col("size"))
    table = table.withColumn("nth", F.row_number().over(running) - 1)
    edges = F.broadcast(starts.join(firsts, ["part", "name"]))
    table = table.join(edges, ["part", "name"])
    begins = (F.col("start") + F.col("inner")).alias("begins")
    table = stored(table.select("row", "name", begins, (F.col("first") + F.col("nth")).alias("nth")), "blocks")
    held = table.agg(F.count(F.lit(1)).alias("n"), F.max("begins").alias("last")).first()
    if not held["n"]:
        none = table.select("row.*", F.col("name").alias("mix_source"), F.col("begins").alias("mix_block"))
        return none.select("*", *[F.lit(0).cast("long").alias(c) for c in ADDED[2:]])
    units = rows.agg(F.sum("size")).first()[0] or 0
    block = max(block, -(-units // MOST_SLOTS))
    table = table.withColumn("block", _div(F.col("begins"), F.lit(block).cast("long"))).drop("begins")
    info = table.groupBy("name").agg((F.max("block") + 1).alias("blocks"))
    info = stored(info.join(wanted, "name", "left"), "sources")
    total = info.agg(F.sum("weight")).first()[0]
    own = F.coalesce("weight", F.lit(rest_weight * (total or 1.0)))
    everything = info.agg(F.sum(own)).first()[0]
    whole = F.greatest(F.lit(1), F.round(own / everything * SCALE)).cast("long")
    info = stored(info.select("name", "blocks", whole.alias("weight")), "shares")
    n = info.agg(F.sum("weight")).first()[0]
    # The slots until every source has had all its blocks once.
    last = _div(F.col("blocks") * n + F.col("weight") - 1, F.col("weight"))
    needed = info.agg(F.max(last)).first()[0]
    made = schedule(info.select("name", "weight"), needed)
    all_turns = _div(F.col("weight") * needed + n - 1, F.lit(n))
    info = info.withColumn("turns", F.greatest(all_turns, "blocks") if repeat else F.col("blocks"))
    turned = table.join(info.drop("weight"), "name")
    epochs = F.sequence(F.lit(0).cast("long"), _div(F.col("turns") - 1 - F.col("block"), F.col("blocks")))
    turned = turned.withColumn("mix_epoch", F.explode(epochs))
    turned = turned.withColumn("mix_block", F.col("block") + F.col("mix_epoch") * F.col("blocks"))
    # A turn beyond the last slot has no slot.
    return turned.join(made, ["name", "mix_block"]).select(
        "row.*",
        F.col("name").alias("mix_source"),
        "mix_block",
        "mix_epoch",
        "mix_slot",
        F.col("nth").alias("mix_place"),
    )


def interleaved(df: DataFrame, weights: dict[str, float] | DataFrame, size: Column, source: str = "source", **options) -> DataFrame:
    """The whole rows of ``mixed`` in the order of the mix, with its columns.

    Only numbers, sources and sizes are scheduled; the rows join the schedule once and
    are sorted by it. Equal rows have one number, and the schedule has every repeat.
    """
    kept = without(df, ADDED)
    row = F.struct(*[col(c) for c in kept])
    rows = df.select(
        row.alias("row"),
        size.cast("long").alias("size"),
        col(source).cast("string").alias("name"),
        row_identity(kept).alias("content"),
    )
    slim = stored(rows.select("content", "name", "size"), "slim")
    plan = stored(mixed(slim, weights, "name", F.col("size"), **options).select("content", *ADDED), "plan")
    if slim.groupBy("content").count().where("count > 1").limit(1).count():
        rows = rows.dropDuplicates(["content"])
    made = rows.select("content", "row").join(plan, "content")
    ordered = made.repartitionByRange("mix_slot", "mix_place").sortWithinPartitions("mix_slot", "mix_place")
    return ordered.select("row.*", *ADDED)
