"""Batch job: recipes in, average total time per difficulty level out.

    spark-submit --py-files larder.zip larder/plans/recipe_job.py --input IN --output OUT
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators.quarantine import quarantined
from larder.operators.recipes import (
    add_difficulty,
    average_by,
    keyword_filter,
    recipe_difficulty,
)
from larder.quality import enforce, run_suite, suite_for
from larder.schemas import CORRUPT_COLUMN, RECIPE, RECIPE_AGGREGATE
from larder.sources import (
    STATUS_OK,
    preprocess_recipes,
    read_arrival_day,
    read_files,
    read_json_lines,
    write_files,
)
from larder.sources.landing import EXECUTION_DAY
from larder.sources.workspace import fresh_folder

log = logging.getLogger(__name__)


def read_recipes(
    spark: SparkSession, path: str, execution_day: dt.date | None = None
) -> DataFrame:
    """All raw recipes under a path, or those that arrived on one day."""
    if execution_day is not None:
        return read_arrival_day(spark, path, execution_day, RECIPE, keep_corrupt=True)
    return read_json_lines(spark, path, RECIPE, keep_corrupt=True)


def _write_result(result: DataFrame, path: str, gate: bool) -> None:
    """Write the few rows of the result; with the gate only after they passed it."""
    if gate:
        staged = fresh_folder(result.sparkSession, "staged")
        write_files(result, staged, "csv", single_file=True)
        result = read_files(result.sparkSession, "csv", staged, RECIPE_AGGREGATE)
        enforce(run_suite(result, suite_for("recipe_aggregate")), "output")
    write_files(result, path, "csv", single_file=True)
    log.info("wrote %s", path)


def run(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    keyword: str = "beef",
    execution_day: dt.date | None = None,
    quarantine_path: str | None = None,
    gate: bool = False,
) -> None:
    """Run the job once.

    With an execution day only that day's arrivals are read, and the result
    goes to that day's folder, so that earlier results stay. ``gate`` checks the
    input before the load and the result before it is published, and raises if a
    constraint fails or there is nothing to check. ``quarantine_path`` receives the
    lines that are no JSON, with their text, and the rows with the keyword whose
    durations cannot be used, with the reason.
    """
    recipes = read_recipes(spark, input_path, execution_day)
    if gate:
        enforce(run_suite(recipes, suite_for("recipe")), "input")
    if quarantine_path:
        corrupt = F.col(CORRUPT_COLUMN).isNotNull()
        chosen = recipes.where(~corrupt).transform(keyword_filter, "ingredients", keyword)
        bad = chosen.unionByName(recipes.where(corrupt)).transform(quarantined)
        write_files(bad, quarantine_path, "parquet")
    target = output_path
    if execution_day is not None:
        target = f"{output_path}/execution_date={execution_day:%Y-%m-%d}"
    _write_result(recipes.transform(recipe_difficulty, keyword=keyword), target, gate)


def preprocess(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    execution_day: dt.date | None = None,
) -> None:
    """Turn raw recipes, or one day's arrivals, into the typed layer that later jobs read."""
    preprocess_recipes(read_recipes(spark, input_path, execution_day), output_path, execution_day)


def run_on_preprocessed(
    spark: SparkSession,
    table_path: str,
    output_path: str,
    keyword: str = "beef",
    gate: bool = False,
    execution_day: dt.date | None = None,
) -> None:
    """The same result from the typed parquet layer, where durations are numbers already.

    With an execution day only that day's load counts. The gate checks the whole
    layer, quarantined rows included. It costs two scans; here they read its columns
    only, while on raw JSON each of them parses all the text.
    """
    layer = read_files(spark, "parquet", table_path)
    if execution_day is not None:
        layer = layer.where(F.col(EXECUTION_DAY) == F.lit(execution_day))
        output_path = f"{output_path}/execution_date={execution_day:%Y-%m-%d}"
    if gate:
        enforce(run_suite(layer, suite_for("recipe")), "input")
    recipes = layer.where(F.col("status") == STATUS_OK)
    result = (
        recipes.transform(keyword_filter, "ingredients", keyword)
        .transform(add_difficulty)
        .transform(average_by)
    )
    _write_result(result, output_path, gate)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument(
        "--step",
        choices=("all", "preprocess", "result"),
        default="all",
        help="raw to result at once, raw to parquet, or parquet to result",
    )
    parser.add_argument("--keyword", default="beef")
    parser.add_argument("--execution-day", type=dt.date.fromisoformat)
    parser.add_argument("--quarantine")
    parser.add_argument("--gate", action="store_true")
    options = parser.parse_args(arguments)
    if options.quarantine and options.step != "all":
        parser.error("--quarantine belongs to --step all; the layer keeps the bad rows itself")
    if options.gate and options.step == "preprocess":
        parser.error("--gate belongs to --step all or result")
    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName("recipe difficulty").getOrCreate()
    if options.step == "preprocess":
        preprocess(spark, options.input, options.output, options.execution_day)
    elif options.step == "result":
        run_on_preprocessed(
            spark,
            options.input,
            options.output,
            options.keyword,
            options.gate,
            options.execution_day,
        )
    else:
        run(
            spark,
            options.input,
            options.output,
            options.keyword,
            options.execution_day,
            options.quarantine,
            options.gate,
        )


if __name__ == "__main__":
    main()
