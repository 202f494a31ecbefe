"""Queries for the sources, the sinks and the partitioned layer.

Each writes whole tables into a folder of its own under the session's shared
folder and reads them back.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.bindings.inputs import document_recipes, event_recipe_rows, event_recipes, iso, table
from larder.bindings.registry import query
from larder.bindings.transforms import (
    COOK,
    DOCUMENT_TOTAL,
    EVENT_KEYWORD,
    FLAGSHIP_SQL,
    PREP,
    TOTAL,
    average_sql,
    difficulty_sql,
)
from larder.operators import quarantine as rules
from larder.operators import recipes
from larder.operators.drift import field_types, typed_with_rest
from larder.plans import current_job, history_job
from larder.plans import recipe_job as job
from larder.schemas import CORRUPT_COLUMN, RECIPE, RECIPE_AGGREGATE
from larder.sources import (
    fresh_folder,
    land_by_partition,
    lookup,
    preprocess_recipes,
    read_arrival_day,
    read_days,
    read_files,
    read_json_lines,
    read_landed,
    type_recipes,
    write_arrivals,
    write_files,
    write_for_lookup,
)
from larder.sources.landing import EXECUTION_DAY

DAY = dt.date(2024, 1, 10)


@query("SELECT * FROM part")
def json_lines_scan(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    path = fresh_folder(spark, "json")
    write_files(part, path, "json")
    return read_json_lines(spark, path, part.schema)


@query("SELECT * FROM customer")
def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    path = fresh_folder(spark, "csv")
    write_files(customer, path, "csv")
    return read_files(spark, "csv", path, customer.schema)


@query(FLAGSHIP_SQL)
def csv_sink(spark: SparkSession, folder: str) -> DataFrame:
    rows = event_recipes(spark, folder)
    result = rows.transform(recipes.recipe_difficulty, keyword=EVENT_KEYWORD)
    path = fresh_folder(spark, "result")
    write_files(result, path, "csv", single_file=True)
    return read_files(spark, "csv", path, RECIPE_AGGREGATE)


@query(average_sql(DOCUMENT_TOTAL, "documents WHERE lower(text) LIKE '%license%'"))
def recipe_job(spark: SparkSession, folder: str) -> DataFrame:
    """The whole batch job: JSON lines in, one CSV file out."""
    arrived, result = fresh_folder(spark, "recipes"), fresh_folder(spark, "result")
    write_files(document_recipes(spark, folder), arrived, "json")
    job.run(spark, arrived, result, keyword="license")
    return read_files(spark, "csv", result, RECIPE_AGGREGATE)


@query("SELECT CAST(ts AS DATE) AS event_date, count(*) AS n FROM events GROUP BY 1")
def partitioned_landing(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").withColumn("event_date", F.to_date("ts"))
    path = fresh_folder(spark, "landed")
    land_by_partition(events, path, ["event_date"])
    return (
        read_landed(spark, path, events.schema)
        .groupBy("event_date")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query("""
    SELECT event_id, user_id, event_type FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10'
""")
def execution_day_read(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").withColumn("event_date", F.to_date("ts"))
    path = fresh_folder(spark, "landed")
    land_by_partition(events, path, ["event_date"])
    return read_days(spark, path, DAY, schema=events.schema).select(
        "event_id", "user_id", "event_type"
    )


@query("""
    SELECT event_id, user_id, event_type FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10'
""")
def arrival_day_read(spark: SparkSession, folder: str) -> DataFrame:
    """Raw files in ``yyyy/MM/dd`` folders, one day of them read."""
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "ts")
    arrived, root = events.drop("ts"), fresh_folder(spark, "arrivals")
    write_arrivals(events.withColumn("day", F.to_date("ts")).drop("ts"), root, "day")
    return read_arrival_day(spark, root, DAY, arrived.schema)


STATUS = "CASE WHEN event_type IN ('error', 'view') THEN 'quarantined' ELSE 'ok' END"


PREPROCESSED_SQL = f"""
    SELECT 'event/' || event_id AS url, event_type AS name,
           CAST(ts AS DATE) AS "datePublished", CAST(year(ts) AS INTEGER) AS published_year,
           {PREP} AS "prepTimeMinutes",
           CASE WHEN event_type NOT IN ('error', 'view') THEN {COOK} END AS "cookTimeMinutes",
           {STATUS} AS status
    FROM events
"""
PREPROCESSED = (
    "url",
    "name",
    "datePublished",
    "published_year",
    "prepTimeMinutes",
    "cookTimeMinutes",
    "status",
)


@query(PREPROCESSED_SQL)
def preprocess_parquet(spark: SparkSession, folder: str) -> DataFrame:
    """Raw recipes persisted as typed parquet by execution day, read back."""
    path = fresh_folder(spark, "preprocessed")
    preprocess_recipes(event_recipe_rows(spark, folder), path)
    return read_landed(spark, path).select(*PREPROCESSED)


@query(f"{PREPROCESSED_SQL} WHERE event_id % 2 = 0 UNION ALL {PREPROCESSED_SQL} WHERE event_id % 2 = 1")
def preprocess_two_days(spark: SparkSession, folder: str) -> DataFrame:
    """Two days' loads into one layer, the second of them twice: every row is there once."""
    path = fresh_folder(spark, "preprocessed")
    rows = event_recipe_rows(spark, folder)
    number = F.substring_index("url", "/", -1).cast("long")
    preprocess_recipes(rows.where(number % 2 == 0), path, DAY)
    later = rows.where(number % 2 == 1)
    spoilt = later.withColumn("cookTime", F.lit("spoilt"))
    for load in (spoilt, later):
        preprocess_recipes(load, path, DAY + dt.timedelta(days=1))
    return read_landed(spark, path).select(*PREPROCESSED)


@query(
    average_sql(TOTAL, "events WHERE event_type LIKE '%c%' AND event_type NOT IN ('error', 'view')")
)
def difficulty_from_parquet(spark: SparkSession, folder: str) -> DataFrame:
    """The result computed from the typed layer instead of the raw text."""
    arrived = fresh_folder(spark, "recipes")
    landed, result = fresh_folder(spark, "preprocessed"), fresh_folder(spark, "result")
    write_files(event_recipe_rows(spark, folder), arrived, "json")
    job.preprocess(spark, arrived, landed)
    job.run_on_preprocessed(spark, landed, result, keyword=EVENT_KEYWORD)
    return read_files(spark, "csv", result, RECIPE_AGGREGATE)


@query("""
    SELECT event_id,
           CASE event_type WHEN 'error' THEN 'malformed cookTime' ELSE 'missing cookTime' END
               AS reason
    FROM events WHERE event_type IN ('error', 'view')
""")
def quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Rows whose durations are no durations: text for errors, none for views."""
    kind = F.col("event_type")
    cook = F.when(kind == "error", F.lit("bad")).when(kind != "view", F.col("cookTime"))
    return (
        event_recipes(spark, folder)
        .withColumn("cookTime", cook)
        .transform(rules.quarantined)
        .select("event_id", "reason")
    )


REASONS_SQL = """
    SELECT reason, count(*) AS n FROM (
        SELECT CASE event_type WHEN 'click' THEN 'corrupt record'
                               WHEN 'error' THEN 'malformed cookTime'
                               WHEN 'view' THEN 'missing cookTime' END AS reason
        FROM events) AS tagged
    WHERE reason IS NOT NULL GROUP BY reason
"""


def lines_with_faults(spark: SparkSession, folder: str) -> str:
    """A folder of JSON lines of which those of clicks are cut short."""
    rows = event_recipe_rows(spark, folder)
    line = F.to_json(F.struct(*[F.col(f"`{name}`") for name in RECIPE.fieldNames()]))
    cut = F.when(F.col("description") == "click", F.substring(line, 1, 40)).otherwise(line)
    path = fresh_folder(spark, "lines")
    write_files(rows.select(cut.alias("value")), path, "text")
    return path


@query(REASONS_SQL)
def quarantine_json(spark: SparkSession, folder: str) -> DataFrame:
    """Lines that are no JSON object (clicks, cut short) next to broken durations."""
    return (
        read_json_lines(spark, lines_with_faults(spark, folder), RECIPE, keep_corrupt=True)
        .select("cookTime", "prepTime", CORRUPT_COLUMN)
        .transform(rules.quarantined)
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(REASONS_SQL)
def quarantine_job(spark: SparkSession, folder: str) -> DataFrame:
    """What the whole job sets aside: cut lines, and rows with the keyword and no durations."""
    result, bad = fresh_folder(spark, "result"), fresh_folder(spark, "bad")
    lines = lines_with_faults(spark, folder)
    job.run(spark, lines, result, keyword="e", quarantine_path=bad)
    return read_files(spark, "parquet", bad).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
    SELECT url, execution_date, name, "prepTimeMinutes", "cookTimeMinutes" FROM (
        SELECT 'user/' || user_id AS url, DATE '2024-01-10' + CAST(event_id % 2 AS INTEGER)
                   AS execution_date,
               event_type AS name, {PREP} AS "prepTimeMinutes", {COOK} AS "cookTimeMinutes",
               row_number() OVER (
                   PARTITION BY user_id
                   ORDER BY event_id % 2 DESC, CAST(ts AS DATE) DESC, event_type DESC,
                            'picture/' || event_id DESC) AS place
        FROM events WHERE event_type NOT IN ('error', 'view')) AS e
    WHERE place = 1
""")
def recipe_current(spark: SparkSession, folder: str) -> DataFrame:
    """Two days' loads merged into the current table: each recipe as its last usable row is."""
    layer, current = fresh_folder(spark, "layer"), fresh_folder(spark, "current")
    rows = event_recipe_rows(spark, folder)
    number = F.substring_index("url", "/", -1).cast("long")
    users = table(spark, folder, "events").select(
        F.concat(F.lit("event/"), F.col("event_id")).alias("url"), "user_id"
    )
    made = rows.join(users, "url").withColumns(
        {"parity": number % 2, "url": F.concat(F.lit("user/"), F.col("user_id"))}
    )
    for parity in (0, 1):
        load = made.where(F.col("parity") == parity).select(*RECIPE.fieldNames())
        day = DAY + dt.timedelta(days=parity)
        preprocess_recipes(load, layer, day)
        current_job.merge_day(spark, layer, current, day)
    state = current_job.read_current(spark, current, DAY + dt.timedelta(days=1))
    return state.select("url", "execution_date", "name", "prepTimeMinutes", "cookTimeMinutes")


DAILY, WEEKLY = "CAST(ts AS DATE)", "CAST(date_trunc('week', ts) AS DATE)"


def _history_sql(day: str) -> str:
    """The intervals by windows: a user's recipe as each dump gives it, then gaps and islands."""
    return f"""
    WITH dumps AS (
             SELECT 'user/' || user_id AS url, {day} AS day, event_type AS name,
                    user_id + event_id % 2 * 60 AS total
             FROM events
             QUALIFY row_number() OVER (PARTITION BY user_id, {day}
                                        ORDER BY event_type DESC, event_id % 2 DESC) = 1),
         loads AS (SELECT day, row_number() OVER (ORDER BY day) AS load,
                          lead(day) OVER (ORDER BY day) AS next_load
                   FROM (SELECT DISTINCT day FROM dumps) AS d),
         seen AS (SELECT *, {difficulty_sql("total")} AS level FROM dumps JOIN loads USING (day)),
         marked AS (SELECT *, CASE WHEN lag(load) OVER k = load - 1 AND lag(name) OVER k = name
                                    AND lag(total) OVER k = total THEN 0 ELSE 1 END AS starts
                    FROM seen WINDOW k AS (PARTITION BY url ORDER BY day)),
         islands AS (SELECT *, sum(starts) OVER (PARTITION BY url ORDER BY day) AS island
                     FROM marked)
    SELECT url, min(day) AS valid_from,
           CASE WHEN bool_or(next_load IS NULL) THEN NULL
                ELSE CAST(max(next_load) - INTERVAL 1 DAY AS DATE) END AS valid_to,
           any_value(name) AS name, any_value(total) AS total, any_value(level) AS level
    FROM islands GROUP BY url, island"""


def _dumped_layer(spark: SparkSession, folder: str, day: Column) -> str:
    """A typed layer into which the users' recipes were dumped on several days."""
    events = table(spark, folder, "events")
    user, hour = F.col("user_id"), F.col("event_id") % 2
    rows = events.select(
        F.col("event_type").alias("name"),
        F.lit("salt").alias("ingredients"),
        iso("user/", user).alias("url"),
        iso("PT", user, "M").alias("cookTime"),
        iso("PT", hour, "H").alias("prepTime"),
        day.cast("date").alias(EXECUTION_DAY),
    )
    absent = {n: F.lit(None).cast("string") for n in RECIPE.fieldNames() if n not in rows.columns}
    path = fresh_folder(spark, "layer")
    land_by_partition(type_recipes(rows.withColumns(absent)), path, [EXECUTION_DAY])
    return path


@query(_history_sql(DAILY))
def recipe_history(spark: SparkSession, folder: str) -> DataFrame:
    """The intervals over which each recipe was there and stayed as it was."""
    return history_job.history_of_layer(spark, _dumped_layer(spark, folder, F.col("ts")))


@query(_history_sql(WEEKLY))
def recipe_history_by_dump(spark: SparkSession, folder: str) -> DataFrame:
    """The history of weekly dumps, carried on dump by dump."""
    layer = _dumped_layer(spark, folder, F.date_trunc("week", "ts"))
    history = fresh_folder(spark, "history")
    days = read_landed(spark, layer).select(EXECUTION_DAY).distinct().orderBy(EXECUTION_DAY)
    for (day,) in days.collect():
        history_job.merge_day(spark, layer, history, day)
    return history_job.read_history(spark, history)


@query("""
    SELECT c_custkey, CASE WHEN c_custkey % 5 = 1 THEN 'too many' WHEN c_custkey % 5 = 2 THEN 'too few'
                           WHEN c_custkey % 5 = 3 THEN 'no number' END AS fault
    FROM customer WHERE c_custkey % 5 IN (1, 2, 3)
""")
def quarantine_csv(spark: SparkSession, folder: str) -> DataFrame:
    """CSV lines that do not fit their schema, found by what was kept of their text."""
    fault = F.col("c_custkey") % 5
    number = F.when(fault == 3, F.lit("many")).otherwise(F.col("c_nationkey").cast("string"))
    more = F.when(fault == 1, F.lit(",more")).otherwise(F.lit(""))
    rest = F.when(fault == 2, F.lit("")).otherwise(F.concat(F.lit(","), number, more))
    lines = table(spark, folder, "customer").select(F.concat(F.col("c_custkey").cast("string"), rest))
    path = fresh_folder(spark, "csv-lines")
    write_files(lines, path, "text")
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("c_custkey", "c_nationkey")])
    read = read_files(spark, "csv", path, schema, header=False, keep_corrupt=True)
    kept = fresh_folder(spark, "bad")
    write_files(rules.quarantined(read, durations=()), kept, "parquet")
    bad = read_files(spark, "parquet", kept)
    fields = F.size(F.split(CORRUPT_COLUMN, ","))
    kind = F.when(fields > 2, "too many").when(fields < 2, "too few").otherwise("no number")
    key = F.split(CORRUPT_COLUMN, ",")[0].cast("bigint")
    return bad.select(key.alias("c_custkey"), kind.alias("fault"))


# Events as JSON lines whose fields change: users become text on the 11th, a field "more"
# comes on the 21st, and the lines of signups are cut off.
_DAY_OF = "CAST(ts AS DATE)"
_SEEN = f"(SELECT *, {_DAY_OF} AS day FROM events WHERE event_type <> 'signup')"


@query(f"""
    SELECT day, field, type, count(*) AS n FROM (
        SELECT day, 'event_id' AS field, 'BIGINT' AS type FROM {_SEEN}
        UNION ALL SELECT day, 'kind', CASE WHEN event_type = 'view' THEN 'VOID' ELSE 'STRING' END
        FROM {_SEEN}
        UNION ALL SELECT day, 'user', CASE WHEN day < DATE '2024-01-11' THEN 'BIGINT' ELSE 'STRING' END
        FROM {_SEEN}
        UNION ALL SELECT day, 'more', 'OBJECT' FROM {_SEEN} WHERE day >= DATE '2024-01-21'
        UNION ALL SELECT day, 'more.k', 'BIGINT' FROM {_SEEN} WHERE day >= DATE '2024-01-21'
    ) AS f GROUP BY ALL
""")
def json_drift(spark: SparkSession, folder: str) -> DataFrame:
    """The types of each field by day, those of nested objects among them."""
    path = fresh_folder(spark, "drifting")
    write_arrivals(_drifting(spark, folder), path, "day", "text")
    day = F.to_date(F.regexp_extract("_metadata.file_path", "/([0-9]+/[0-9]+/[0-9]+)/[^/]*$", 1), "yyyy/MM/dd")
    lines = spark.read.text(f"{path}/*/*/*").select("value", day.alias("day"))
    docs = lines.withColumn("doc", F.try_parse_json("value"))
    return field_types(docs, "doc", ["day"], depth=2)


def _drifting(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").withColumn("day", F.to_date("ts"))
    user = F.when(F.col("day") < "2024-01-11", F.col("user_id").cast("string")).otherwise(
        F.concat(F.lit('"u'), F.col("user_id"), F.lit('"'))
    )
    kind = F.when(F.col("event_type") == "view", F.lit("null")).otherwise(
        F.concat(F.lit('"'), F.col("event_type"), F.lit('"'))
    )
    more = F.when(F.col("day") >= "2024-01-21", F.concat(F.lit(', "more": '), "props")).otherwise(F.lit(""))
    line = F.concat(
        F.lit('{"event_id": '), "event_id", F.lit(', "user": '), user, F.lit(', "kind": '), kind, more, F.lit("}")
    )
    cut = F.when(F.col("event_type") == "signup", F.left(line, F.lit(9))).otherwise(line)
    return events.select(cut.alias("value"), "day")


@query("""
    SELECT event_id, event_type, CASE WHEN day < DATE '2024-01-11' THEN user_id END AS "user",
           CASE WHEN day >= DATE '2024-01-21' THEN 'u' || user_id || '/' || regexp_extract(props, '[0-9]+')
                WHEN day >= DATE '2024-01-11' THEN 'u' || user_id END AS rest
    FROM (SELECT *, CAST(ts AS DATE) AS day FROM events) AS e
    WHERE event_type NOT IN ('signup', 'view')
""")
def json_rest(spark: SparkSession, folder: str) -> DataFrame:
    """The lines as typed columns; what does not fit them survives in the layer as it came."""
    schema = T.StructType(
        [T.StructField("event_id", T.LongType()), T.StructField("user", T.LongType()), T.StructField("kind", T.StringType())]
    )
    path = fresh_folder(spark, "typed")
    typed_with_rest(_drifting(spark, folder), schema).write.parquet(path)
    rest = F.concat_ws(
        "/", F.try_variant_get("rest", "$.user", "string"), F.try_variant_get("rest", "$.more.k", "string")
    )
    rows = spark.read.parquet(path).where(F.col("kind").isNotNull())
    return rows.select(
        "event_id",
        F.col("kind").alias("event_type"),
        "user",
        F.when(F.col("rest").isNotNull(), rest).alias("rest"),
    )


@query("""
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_custkey % 97 = 5)
""")
def recipe_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Orders laid out by customer, and those of some customers found there."""
    orders = table(spark, folder, "orders")
    path = fresh_folder(spark, "by-customer")
    write_for_lookup(orders, path, "o_custkey", files=8, group_bytes=1 << 16)
    wanted = table(spark, folder, "customer").where("c_custkey % 97 = 5").select("c_custkey")
    found = lookup(spark, path, "o_custkey", [r[0] for r in wanted.collect()], orders.schema)
    return found.select("o_orderkey", "o_custkey", "o_totalprice")
