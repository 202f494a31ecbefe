"""JSON whose fields and types change: nothing is lost, and what changed can be seen.

Lines are kept as VARIANT, which holds any JSON value with its type. Expected fields are
read from it as typed columns, the whole object stays next to them where it has more.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.schemas import CORRUPT_COLUMN

#: What a value is called that is no object, no array and no plain value: a JSON null.
NULL = "VOID"


def _path(name: str) -> str:
    """The path of a field by its exact name."""
    return "$['" + name.replace("'", "\\'") + "']"


def _kind(value: Column) -> Column:
    """The kind of a variant, without what it is made of: OBJECT, ARRAY, BIGINT, DECIMAL, ..."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z_ ]+", 0)


def typed_with_rest(lines: DataFrame, schema: T.StructType, line: str = "value") -> DataFrame:
    """JSON lines as the expected columns, and ``rest``: what the columns do not hold.

    A field that is absent, or null, or of a type that cannot be read as its column's, is
    NULL there. ``rest`` is the whole object, as a VARIANT, if it has a field that the
    schema does not name or a value that its column cannot hold, else NULL; so no field
    is lost. ``_corrupt_record`` has the text of lines that are no object.
    """
    taken = {name.lower() for name in schema.fieldNames()} & {"rest", CORRUPT_COLUMN}
    if taken:
        raise ValueError(f"rename the columns {sorted(taken)} first")
    parsed = lines.select(F.col(line).alias("line"), F.try_parse_json(F.col(line)).alias("doc"))
    doc = F.when(_kind(F.col("doc")) == "OBJECT", F.col("doc"))
    parsed = parsed.select("line", doc.alias("doc"))
    # As text a nested value is its JSON.
    columns = [
        F.try_variant_get("doc", _path(f.name), f.dataType.simpleString()).alias(f.name) for f in schema.fields
    ]
    asked = {f.name: F.try_variant_get("doc", _path(f.name), "variant") for f in schema.fields}
    misfits = [
        asked[f.name].isNotNull() & (_kind(asked[f.name]) != NULL) & column.isNull()
        for f, column in zip(schema.fields, columns, strict=True)
    ]
    fields = F.json_object_keys("line")
    known = F.array(*[F.lit(name) for name in schema.fieldNames()]) if schema.fields else F.array().cast("array<string>")
    more = F.size(F.array_except(fields, known)) > 0
    odd = more
    for misfit in misfits:
        odd = odd | misfit
    return parsed.select(
        *columns,
        F.when(odd, F.col("doc")).alias("rest"),
        F.when(F.col("doc").isNull(), F.col("line")).alias(CORRUPT_COLUMN),
    )


def field_types(df: DataFrame, doc: str, by: Sequence[str] = (), depth: int = 1) -> DataFrame:
    """``by, field, type, n``: in how many rows each field of an object has each type.

    ``doc`` is a VARIANT column. With a greater depth fields of nested objects are counted
    too, as ``outer.inner``. Types are the kinds of JSON values as VARIANT tells them apart;
    a JSON null is VOID. Rows without an object have no fields. Counts add up before the
    shuffle, so it moves a row for each field, type and group of a task.
    """
    keys = [F.col(f"`{name}`").alias(f"by{i}") for i, name in enumerate(by)]
    names = [f"by{i}" for i in range(len(by))]
    level = df.select(*keys, F.lit(None).cast("string").alias("field"), F.col(doc).alias("doc"))
    counts = None
    for _ in range(depth):
        level = level.where(_kind(F.col("doc")) == "OBJECT")
        found = level.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("doc").outer()))
        # Dots within a name would look like nesting.
        field = F.concat_ws(".", "field", F.replace(F.col("key"), F.lit("."), F.lit("\\.")))
        level = found.select(*names, field.alias("field"), F.col("value").alias("doc"))
        counted = level.select(*names, "field", _kind(F.col("doc")).alias("type"))
        counts = counted if counts is None else counts.unionByName(counted)
    shown = [F.col(n).alias(name) for n, name in zip(names, by, strict=True)]
    totals = counts.groupBy(*names, "field", "type").agg(F.count(F.lit(1)).alias("n"))
    return totals.select(*shown, "field", "type", "n")


def drift(types: DataFrame, by: str, expected: dict[str, str]) -> DataFrame:
    """What of the counted types is unexpected: a field without a type, or with another one.

    Gives ``field, type, first, last, n``: the first and last value of ``by`` at which it
    was seen. ``expected`` has the kind by field; a null is always expected of it.
    """
    pairs = [F.lit(text) for pair in expected.items() for text in pair]
    wanted = F.try_element_at(F.create_map(*pairs), F.col("field")) if pairs else F.lit(None).cast("string")
    odd = wanted.isNull() | ((wanted != F.col("type")) & (F.col("type") != NULL))
    day = F.col(f"`{by}`")
    return (
        types.where(odd)
        .groupBy("field", "type")
        .agg(F.min(day).alias("first"), F.max(day).alias("last"), F.sum("n").alias("n"))
    )
