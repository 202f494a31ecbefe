"""Queries for the micro-batch jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder import streaming
from larder.bindings.files import (
    DAY,
    PREPROCESSED,
    PREPROCESSED_SQL,
    REASONS_SQL,
    lines_with_faults,
)
from larder.bindings.inputs import event_recipe_rows, event_recipes, table
from larder.bindings.registry import query
from larder.bindings.transforms import EVENT_KEYWORD, FLAGSHIP_SQL, TOTAL, difficulty_sql
from larder.operators import recipes
from larder.schemas import RECIPE
from larder.sources import (
    fresh_folder,
    land_by_partition,
    read_days,
    read_landed,
    type_recipes,
    write_arrivals,
    write_files,
)
from larder.sources.landing import EXECUTION_DAY
from larder.sources.layer import arrival_day, publish_day, read_layer
from larder.streaming import (
    current_average,
    latest_average,
    stream_average,
    stream_files,
    stream_to_layer,
    stream_to_partitions,
)


def _arrivals(df: DataFrame, label: str) -> str:
    """A folder into which the rows have arrived day by day."""
    path = fresh_folder(df.sparkSession, label)
    land_by_partition(df.withColumn("arrival", F.to_date("ts")), path, ["arrival"])
    return path


def _wave(spark: SparkSession) -> int:
    """Files per batch such that a batch gives each core one file."""
    return spark.sparkContext.defaultParallelism


EVENT_DAYS = T.StructField("event_date", T.DateType())


def _landed_events(spark: SparkSession, folder: str) -> tuple[str, T.StructType]:
    """All events landed by day as a stream: the table's path and schema."""
    events = table(spark, folder, "events")
    stream = stream_files(
        spark, _arrivals(events, "arrivals"), events.schema, "parquet", _wave(spark)
    )
    landed = fresh_folder(spark, "landed")
    stream_to_partitions(
        stream.withColumn("event_date", F.to_date("ts")),
        landed,
        fresh_folder(spark, "progress"),
        ["event_date"],
    )
    return landed, T.StructType([*events.schema.fields, EVENT_DAYS])


@query("SELECT CAST(ts AS DATE) AS event_date, count(*) AS n FROM events GROUP BY 1")
def stream_landing(spark: SparkSession, folder: str) -> DataFrame:
    landed, schema = _landed_events(spark, folder)
    return (
        read_landed(spark, landed, schema)
        .groupBy("event_date")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query("""
    SELECT event_id, user_id, event_type FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10'
""")
def stream_day_read(spark: SparkSession, folder: str) -> DataFrame:
    """One day of a table that a stream has written, by the stream's log of files."""
    landed, schema = _landed_events(spark, folder)
    return read_days(spark, landed, DAY, schema=schema).select("event_id", "user_id", "event_type")


@query(REASONS_SQL)
def stream_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """The reasons kept by a stream of raw lines, those that are no JSON among them."""
    lines, landed = lines_with_faults(spark, folder), fresh_folder(spark, "landed")
    stream = stream_files(spark, lines, RECIPE, files_per_batch=_wave(spark), keep_corrupt=True)
    progress = fresh_folder(spark, "progress")
    stream_to_partitions(stream.transform(type_recipes), landed, progress, ["status"])
    bad = read_landed(spark, landed).where("status = 'quarantined'")
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query(PREPROCESSED_SQL)
def stream_preprocess(spark: SparkSession, folder: str) -> DataFrame:
    """Raw recipes arriving as JSON, persisted as typed parquet by status and year."""
    arrived = fresh_folder(spark, "recipes")
    write_files(event_recipe_rows(spark, folder), arrived, "json")
    stream = stream_files(spark, arrived, RECIPE, files_per_batch=_wave(spark))
    landed = fresh_folder(spark, "landed")
    stream_to_partitions(
        stream.transform(type_recipes),
        landed,
        fresh_folder(spark, "progress"),
        ["status", "published_year"],
    )
    return read_landed(spark, landed).select(*PREPROCESSED)


@query(FLAGSHIP_SQL)
def stream_avg_by_bucket(spark: SparkSession, folder: str) -> DataFrame:
    rows = event_recipes(spark, folder)
    stream = stream_files(spark, _arrivals(rows, "arrivals"), rows.schema, "parquet", _wave(spark))
    results = fresh_folder(spark, "results")
    stream_average(
        stream.transform(recipes.label_recipes, keyword=EVENT_KEYWORD),
        results,
        fresh_folder(spark, "progress"),
    )
    return latest_average(spark, results)


@query(f"""
    SELECT {difficulty_sql(TOTAL)} AS difficulty, avg({TOTAL}) AS avg_total_cooking_time
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place
          FROM events) AS e
    WHERE place = 1 AND event_type LIKE '%c%' GROUP BY 1
""")
def stream_current_average(spark: SparkSession, folder: str) -> DataFrame:
    """Each user as a recipe that every event edits: the newest edit counts, if it has the keyword."""
    rows = event_recipes(spark, folder).join(
        table(spark, folder, "events").select("event_id", "user_id"), "event_id"
    )
    stream = stream_files(spark, _arrivals(rows, "arrivals"), rows.schema, "parquet", _wave(spark))
    found = F.contains(F.lower("ingredients"), F.lit(EVENT_KEYWORD.lower()))
    labelled = stream.transform(recipes.add_minutes).transform(recipes.add_difficulty)
    labelled = labelled.withColumn("difficulty", F.when(found, F.col("difficulty")))
    state = fresh_folder(spark, "newest")
    progress = fresh_folder(spark, "progress")
    streaming.stream_current_average(
        labelled, state, progress, "user_id", ["ts", "event_id"], buckets=16
    )
    return current_average(spark, state)


@query(f"""
    SELECT execution_date, status, count(*) AS n, CAST(sum("prepTimeMinutes") AS BIGINT) AS minutes
    FROM (SELECT *, "datePublished" AS execution_date FROM ({PREPROCESSED_SQL}) AS p) AS d
    GROUP BY 1, 2
""")
def stream_layer(spark: SparkSession, folder: str) -> DataFrame:
    """Arriving days streamed into the layer of the batch loads; one day is loaded again."""
    rows = event_recipe_rows(spark, folder)
    arrivals, layer = fresh_folder(spark, "arrivals"), fresh_folder(spark, "layer")
    write_arrivals(rows.withColumn("day", F.to_date("datePublished")), arrivals, "day")
    stream = stream_files(spark, f"{arrivals}/*/*/*", RECIPE, files_per_batch=_wave(spark))
    stream_to_layer(stream, layer, fresh_folder(spark, "progress"), arrival_day())
    publish_day(rows.where(F.col("datePublished") == str(DAY)), layer, DAY)
    counts = read_layer(spark, layer).groupBy(EXECUTION_DAY, "status")
    return counts.agg(F.count(F.lit(1)).alias("n"), F.sum("prepTimeMinutes").alias("minutes"))


# Events come in three waves, a run of the stream for each: those up to the 15th but for
# every seventh, the rest with repeats of the day before, and at last every seventh of the
# first half, together with repeats of the last day. The delay is two days.
_LATE = "event_id % 7 = 3 AND CAST(ts AS DATE) <= DATE '2024-01-15'"


@query(f"""
    SELECT CAST(ts AS DATE) AS event_date, CASE WHEN {_LATE} THEN 'late' ELSE 'landed' END AS fate,
           count(*) AS n
    FROM events GROUP BY 1, 2
""")
def stream_deduplicated(spark: SparkSession, folder: str) -> DataFrame:
    """Repeats across batches and restarts are landed once, late events are set aside."""
    events = table(spark, folder, "events").withColumn("event_date", F.to_date("ts"))
    day, held_back = F.col("event_date"), F.expr(_LATE)
    waves = [
        events.where((day <= "2024-01-15") & ~held_back),
        events.where((day >= "2024-01-15") & ~held_back),
        events.where(held_back | (day == F.lit("2024-01-30").cast("date"))),
    ]
    source, landed = fresh_folder(spark, "waves"), fresh_folder(spark, "landed")
    progress = fresh_folder(spark, "progress")
    for number, wave in enumerate(waves):
        wave.withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(f"{source}/wave={number}")
        schema = spark.read.parquet(f"{source}/wave={number}").schema
        stream = stream_files(spark, f"{source}/*", schema, "parquet")
        streaming.stream_deduplicated(
            stream, landed, progress, ["event_id"], "ts", "2 days", ["event_date"]
        )
    kept = read_landed(spark, landed)
    late = streaming.late_rows(spark.read.parquet(f"{source}/*"), kept, ["event_id"])
    fates = [
        rows.select("event_date", F.lit(fate).alias("fate")) for rows, fate in ((kept, "landed"), (late, "late"))
    ]
    return fates[0].unionByName(fates[1]).groupBy("event_date", "fate").agg(F.count(F.lit(1)).alias("n"))
