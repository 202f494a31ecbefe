"""The recipe transforms: filter, durations, total, difficulty label, average."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import duration_minutes

# Difficulty levels by total minutes, as (label, lower, upper).
# A bucket open at one end leaves its bound out; a closed one holds both bounds.
DIFFICULTY_LEVELS = (
    ("easy", None, 30),
    ("medium", 30, 60),
    ("hard", 60, None),
)

Bucket = tuple[str, float | None, float | None]


def keyword_filter(
    df: DataFrame, column: str = "ingredients", keyword: str = "beef"
) -> DataFrame:
    """Rows whose text holds the keyword anywhere, in any case; NULL text is left out."""
    return df.where(F.contains(F.lower(F.col(column)), F.lit(keyword.lower())))


def add_minutes(
    df: DataFrame, columns: Mapping[str, str] | None = None, wrap_days: bool = False
) -> DataFrame:
    """Add whole minutes for each duration column, given as ``{text: minutes}``."""
    columns = columns or {"prepTime": "prepTimeMinutes", "cookTime": "cookTimeMinutes"}
    return df.withColumns(
        {minutes: duration_minutes(text, wrap_days) for text, minutes in columns.items()}
    )


def add_total(
    df: DataFrame,
    parts: Sequence[str] = ("cookTimeMinutes", "prepTimeMinutes"),
    total: str = "total_cook_time",
) -> DataFrame:
    """Add the sum of the parts, NULL if any part is."""
    result = F.col(parts[0])
    for part in parts[1:]:
        result = result + F.col(part)
    return df.withColumn(total, result)


def _in_bucket(value: Column, lower: float | None, upper: float | None) -> Column:
    if lower is None:
        return value < F.lit(upper)
    if upper is None:
        return value > F.lit(lower)
    return value.between(F.lit(lower), F.lit(upper))


def bucket_label(
    value: Column, buckets: Sequence[Bucket] = DIFFICULTY_LEVELS, null_label: str | None = None
) -> Column:
    """The label of the first bucket that holds the value."""
    label = F.when(value.isNull(), F.lit(null_label))
    for name, lower, upper in buckets:
        label = label.when(_in_bucket(value, lower, upper), F.lit(name))
    return label


def add_difficulty(
    df: DataFrame,
    total: str = "total_cook_time",
    label: str = "difficulty",
    buckets: Sequence[Bucket] = DIFFICULTY_LEVELS,
    null_label: str | None = None,
) -> DataFrame:
    """Add the difficulty label, and the total first where it is not there yet.

    A NULL total gets ``null_label``: NULL by default, ``"hard"`` to let it fall
    into the last level.
    """
    if total not in df.columns:
        df = add_total(df, total=total)
    return df.withColumn(label, bucket_label(F.col(total), buckets, null_label))


def average_by(
    df: DataFrame,
    key: str = "difficulty",
    value: str = "total_cook_time",
    name: str = "avg_total_cooking_time",
) -> DataFrame:
    """The average per label; rows without a label belong to the quarantine, not here.

    The group without a label is dropped after the aggregation, by a condition
    Catalyst cannot move below it: down there the whole label expression, with
    the parsing of both durations, would be evaluated once more per row.
    """
    labelled = F.bool_or(F.col(key).isNotNull())
    return (
        df.groupBy(key)
        .agg(F.avg(value).alias(name), labelled.alias("__labelled"))
        .where("__labelled")
        .drop("__labelled")
    )


def project(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Keep and rename columns, given as ``{new name: old name}``."""
    return df.select(*[F.col(old).alias(new) for new, old in columns.items()])


def label_recipes(
    recipes: DataFrame,
    column: str = "ingredients",
    keyword: str = "beef",
    wrap_days: bool = False,
    null_label: str | None = None,
) -> DataFrame:
    """Recipes with the keyword, with minutes, total and difficulty, row by row."""
    return (
        recipes.transform(keyword_filter, column, keyword)
        .transform(add_minutes, wrap_days=wrap_days)
        .transform(add_total)
        .transform(add_difficulty, null_label=null_label)
    )


def recipe_difficulty(recipes: DataFrame, **options) -> DataFrame:
    """Average total time per difficulty level of the recipes with the keyword."""
    return label_recipes(recipes, **options).transform(average_by)
