"""Batch job: two dumps of the recipe archive in, what changed between them out.

    spark-submit --py-files larder.zip larder/plans/change_job.py \\
        --before IN --after IN --output OUT [--duplicates OUT] [--quarantine BAD]
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators.compare import snapshot_changes, snapshot_duplicates
from larder.operators.quarantine import quarantined, usable
from larder.operators.recipes import add_difficulty, add_minutes, add_total
from larder.schemas import RECIPE
from larder.sources import read_json_lines, write_files

log = logging.getLogger(__name__)

KEY = "url"
VERSION = "datePublished"
TRACKED = ("name", "total_cook_time", "difficulty")


def recipe_state(recipes: DataFrame) -> DataFrame:
    """What is tracked of each recipe: name, total time and difficulty, and its date."""
    return (
        recipes.transform(add_minutes)
        .transform(add_total)
        .transform(add_difficulty)
        .select(KEY, VERSION, *TRACKED)
    )


def run(
    spark: SparkSession,
    before_path: str,
    after_path: str,
    output_path: str,
    duplicates_path: str | None = None,
    quarantine_path: str | None = None,
) -> None:
    """Write recipes added, removed or changed, with old and new values, as parquet.

    Of several rows with one URL the one published last counts; ``duplicates_path``
    receives those URLs with their numbers of rows. Lines that are no JSON and rows
    without a URL take no part and go to ``quarantine_path`` with the reason and the
    snapshot they are from.
    """
    raw = {
        side: read_json_lines(spark, path, RECIPE, keep_corrupt=True)
        for side, path in (("before", before_path), ("after", after_path))
    }
    rules = {"durations": (), "extra": {f"missing {KEY}": F.col(KEY).isNull()}}
    if quarantine_path:
        bad = [
            quarantined(rows, **rules).withColumn("snapshot", F.lit(side))
            for side, rows in raw.items()
        ]
        write_files(bad[0].unionByName(bad[1]), quarantine_path, "parquet")
    before, after = (recipe_state(usable(rows, **rules)) for rows in raw.values())
    if duplicates_path:
        write_files(snapshot_duplicates(before, after, KEY), duplicates_path, "parquet")
    write_files(snapshot_changes(before, after, KEY, TRACKED, [VERSION]), output_path, "parquet")
    log.info("wrote %s", output_path)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--before", required=True)
    parser.add_argument("--after", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--duplicates")
    parser.add_argument("--quarantine")
    options = parser.parse_args(arguments)
    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName("recipe changes").getOrCreate()
    run(
        spark,
        options.before,
        options.after,
        options.output,
        options.duplicates,
        options.quarantine,
    )


if __name__ == "__main__":
    main()
