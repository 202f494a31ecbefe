"""Batch job: a dataset in, its validation report out.

    spark-submit --py-files larder.zip larder/plans/quality_job.py \\
        --dataset recipe --input IN --report OUT
"""

from __future__ import annotations

import argparse
import logging

from pyspark import StorageLevel
from pyspark.sql import SparkSession

from larder.quality import format_report, run_suite, suite_for
from larder.schemas import RECIPE, RECIPE_AGGREGATE
from larder.sources import read_files, write_files

log = logging.getLogger(__name__)

# A suite of a dataset not listed here is run on the schema its files show.
DATASET_SCHEMAS = {"recipe": RECIPE, "recipe_aggregate": RECIPE_AGGREGATE}


def run(
    spark: SparkSession,
    dataset: str,
    input_path: str,
    report_path: str,
    file_format: str = "json",
    persist: bool = False,
) -> bool:
    """Check one dataset and write the report; False if it was empty and none was written.

    ``persist`` keeps the checked columns between the two scans a suite may
    need. It pays where reading is dear (JSON) and the executors have room; a
    parquet input is read faster than the copy.
    """
    suite = suite_for(dataset)
    data = read_files(spark, file_format, input_path, DATASET_SCHEMAS.get(suite.name))
    data = data.select(*suite.columns)
    if data.isEmpty():
        log.warning("%s is empty, no report written", input_path)
        return False
    if persist:
        data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        results = run_suite(data, suite).repartition(1).sortWithinPartitions("ordinal")
        write_files(format_report(results), report_path, "csv")
    finally:
        if persist:
            data.unpersist()
    log.info("wrote %s", report_path)
    return True


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--dataset", required=True)
    parser.add_argument("--input", required=True)
    parser.add_argument("--report", required=True)
    parser.add_argument("--format", default="json")
    parser.add_argument("--persist", action="store_true")
    options = parser.parse_args(arguments)
    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName("data quality").getOrCreate()
    run(
        spark,
        options.dataset,
        options.input,
        options.report,
        options.format,
        options.persist,
    )


if __name__ == "__main__":
    main()
