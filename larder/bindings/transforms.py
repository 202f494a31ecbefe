"""Queries for the recipe transforms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.bindings.inputs import document_recipes, event_recipes, iso, table
from larder.bindings.registry import query
from larder.functions import duration_minutes as minutes_of
from larder.functions import duration_seconds as seconds_of
from larder.operators import recipes

# The minutes that `event_recipes` puts into its texts, from the numbers.
COOK = "user_id"
PREP = "((event_id % 2) * 3600 + event_id % 3600) // 60"
TOTAL = f"({COOK} + {PREP})"


def difficulty_sql(total: str) -> str:
    return (
        f"CASE WHEN {total} < 30 THEN 'easy' WHEN {total} <= 60 THEN 'medium' ELSE 'hard' END"
    )


def average_sql(total: str, source: str) -> str:
    return f"""
        SELECT {difficulty_sql(total)} AS difficulty,
               avg({total}) AS avg_total_cooking_time
        FROM {source} GROUP BY 1"""


# Clicks and purchases, whatever the case of the keyword.
EVENT_KEYWORD = "C"
FLAGSHIP_SQL = average_sql(TOTAL, "events WHERE event_type LIKE '%c%'")


@query(FLAGSHIP_SQL)
def recipe_difficulty(spark: SparkSession, folder: str) -> DataFrame:
    rows = event_recipes(spark, folder)
    return rows.transform(recipes.recipe_difficulty, keyword=EVENT_KEYWORD)


DOCUMENT_TOTAL = "(n_chars // 60 + doc_id % 45)"


@query(average_sql(DOCUMENT_TOTAL, "documents WHERE lower(text) LIKE '%license%'"))
def recipe_difficulty_text(spark: SparkSession, folder: str) -> DataFrame:
    rows = document_recipes(spark, folder)
    return rows.transform(recipes.recipe_difficulty, keyword="license")


@query("SELECT doc_id FROM documents WHERE lower(text) LIKE '%license%'")
def keyword_filter(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return documents.transform(recipes.keyword_filter, "text", "License").select("doc_id")


@query(f"""
    SELECT event_id, {PREP} AS "prepTimeMinutes", {COOK} AS "cookTimeMinutes" FROM events
""")
def duration_minutes(spark: SparkSession, folder: str) -> DataFrame:
    return (
        event_recipes(spark, folder)
        .transform(recipes.add_minutes)
        .select("event_id", "prepTimeMinutes", "cookTimeMinutes")
    )


@query("""
    SELECT event_id,
           CAST(floor((event_id % 3) * 604800 + (event_id % 7) * 86400 + (event_id % 24) * 3600
                      + (event_id % 60) * 60 + 30 + (event_id % 50) + 0.25) AS BIGINT) AS seconds
    FROM events
""")
def duration_units(spark: SparkSession, folder: str) -> DataFrame:
    """Every unit at once, with fractions after a comma and after a point."""
    event = F.col("event_id")
    text = iso(
        "P", event % 3, "W", event % 7, "DT", event % 24, "H",
        event % 60, ",5M", event % 50, ".25S",
    )
    return table(spark, folder, "events").select("event_id", seconds_of(text).alias("seconds"))


@query("SELECT event_id, (user_id * 60 % 86400) // 60 AS minutes FROM events")
def duration_wrapped(spark: SparkSession, folder: str) -> DataFrame:
    """Only the part below one day counts."""
    text = iso("PT", F.col("user_id"), "M")
    return table(spark, folder, "events").select(
        "event_id", minutes_of(text, wrap_days=True).alias("minutes")
    )


@query(f"SELECT event_id, {TOTAL} AS total_cook_time FROM events")
def total_duration(spark: SparkSession, folder: str) -> DataFrame:
    return (
        event_recipes(spark, folder)
        .transform(recipes.add_minutes)
        .transform(recipes.add_total)
        .select("event_id", "total_cook_time")
    )


@query(f"""
    SELECT event_id, {TOTAL} AS total_cook_time, {difficulty_sql(TOTAL)} AS difficulty FROM events
""")
def duration_bucket(spark: SparkSession, folder: str) -> DataFrame:
    return (
        event_recipes(spark, folder)
        .transform(recipes.add_minutes)
        .transform(recipes.add_difficulty)
        .select("event_id", "total_cook_time", "difficulty")
    )


@query(average_sql(TOTAL, "events"))
def avg_by_bucket(spark: SparkSession, folder: str) -> DataFrame:
    return (
        event_recipes(spark, folder)
        .transform(recipes.add_minutes)
        .transform(recipes.add_difficulty)
        .transform(recipes.average_by)
    )


@query(f"SELECT {difficulty_sql(TOTAL)} AS level, {TOTAL} AS minutes FROM events")
def project_rename(spark: SparkSession, folder: str) -> DataFrame:
    return (
        event_recipes(spark, folder)
        .transform(recipes.add_minutes)
        .transform(recipes.add_difficulty)
        .transform(recipes.project, {"level": "difficulty", "minutes": "total_cook_time"})
    )
