"""Recipe-shaped inputs made from the benchmark tables.

The tables hold no recipes, so ISO-8601 text is made from their numbers. The SQL
side works on the numbers directly and never parses the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def iso(*parts: str | Column) -> Column:
    """Text joined from literals and numeric columns."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def event_recipes(spark: SparkSession, folder: str) -> DataFrame:
    """Events as recipes: minutes from the user, hours and seconds from the event number."""
    event, user = F.col("event_id"), F.col("user_id")
    return table(spark, folder, "events").select(
        "event_id",
        "ts",
        "event_type",
        F.col("event_type").alias("ingredients"),
        iso("PT", user, "M").alias("cookTime"),
        iso("PT", event % 2, "H", event % 3600, "S").alias("prepTime"),
    )


def document_recipes(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as recipes with all the columns of the recipe schema.

    The whole text is the ingredients, the language stands for the picture and
    is missing for French.
    """
    return table(spark, folder, "documents").select(
        F.col("source").alias("name"),
        F.col("text").alias("ingredients"),
        iso("doc/", F.col("doc_id")).alias("url"),
        F.nullif("lang", F.lit("fr")).alias("image"),
        iso("PT", F.col("n_chars"), "S").alias("cookTime"),
        F.lit("4").alias("recipeYield"),
        F.lit("2013-01-14").alias("datePublished"),
        iso("PT", F.col("doc_id") % 45, "M").alias("prepTime"),
        F.col("lang").alias("description"),
    )


def event_recipe_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Events with all the columns of the recipe schema; errors have broken durations."""
    kind = F.col("event_type")
    cook = F.when(kind == "error", F.lit("soon")).when(kind != "view", F.col("cookTime"))
    return event_recipes(spark, folder).select(
        iso(" ", kind, " ").alias("name"),
        "ingredients",
        iso("event/", F.col("event_id")).alias("url"),
        iso("picture/", F.col("event_id")).alias("image"),
        cook.alias("cookTime"),
        F.lit("4").alias("recipeYield"),
        F.date_format("ts", "yyyy-MM-dd").alias("datePublished"),
        "prepTime",
        kind.alias("description"),
    )
