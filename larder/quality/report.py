"""The validation report as it is written to file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def format_report(results: DataFrame) -> DataFrame:
    """Suite results as ``File_Name, Test_Case_Id, Test_Case, Test_Result``.

    The case number is the constraint's position in its suite, so it does not
    depend on how the results happen to be partitioned.
    """
    file_name = F.upper("check")
    return results.select(
        file_name.alias("File_Name"),
        F.concat(file_name, F.lit("_TC_"), F.col("ordinal").cast("string")).alias("Test_Case_Id"),
        F.col("constraint").alias("Test_Case"),
        F.col("constraint_status").alias("Test_Result"),
    )
