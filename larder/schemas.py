"""Explicit schemas, so that no read has to make an inference pass over its input."""

from pyspark.sql import types as T

CORRUPT_COLUMN = "_corrupt_record"

RECIPE = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "name",
            "ingredients",
            "url",
            "image",
            "cookTime",
            "recipeYield",
            "datePublished",
            "prepTime",
            "description",
        )
    ]
)

RECIPE_AGGREGATE = T.StructType(
    [
        T.StructField("difficulty", T.StringType()),
        T.StructField("avg_total_cooking_time", T.DoubleType()),
    ]
)

VALIDATION_REPORT = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("File_Name", "Test_Case_Id", "Test_Case", "Test_Result")
    ]
)


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    """The schema plus the column in which the JSON reader keeps a bad line's text."""
    if CORRUPT_COLUMN in schema.fieldNames():
        return schema
    return T.StructType([*schema.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
