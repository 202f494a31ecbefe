"""Queries for the constraint suites, the profile and the gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder import quality as q
from larder.bindings.inputs import document_recipes, event_recipes, table
from larder.bindings.registry import query
from larder.bindings.transforms import EVENT_KEYWORD, FLAGSHIP_SQL
from larder.operators import profile, recipes
from larder.plans import quality_job as job
from larder.quality import incremental
from larder.schemas import VALIDATION_REPORT
from larder.sources import fresh_folder, read_files, write_files


def _status(metric: str) -> str:
    return f"CASE WHEN {metric} = 1 THEN 'Success' ELSE 'Failure' END"


def _share(condition: str, source: str) -> str:
    return f"(SELECT avg(CASE WHEN {condition} THEN 1.0 ELSE 0.0 END) FROM {source})"


def _unique_share(column: str, source: str) -> str:
    return (
        "(SELECT sum(CASE WHEN n = 1 THEN 1 ELSE 0 END) / sum(n) FROM "
        f"(SELECT count(*) AS n FROM {source} WHERE {column} IS NOT NULL GROUP BY {column}) AS g)"
    )


def _results_sql(metrics: list[tuple[str, str]], columns: str, check: str = "") -> str:
    """Rows ``ordinal, check, constraint, metric, constraint_status`` cut to some columns."""
    rows = " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS ordinal, '{check}' AS \"check\", "
        f"'{label.replace(chr(39), chr(39) * 2)}' AS \"constraint\", "
        f"CAST({metric} AS DOUBLE) AS metric"
        for i, (label, metric) in enumerate(metrics)
    )
    return f"""SELECT {columns} FROM (
        SELECT *, {_status("metric")} AS constraint_status FROM ({rows}) AS m) AS r"""


RESULT = '"constraint", metric, constraint_status'


def _result(df: DataFrame, *constraints: q.Constraint) -> DataFrame:
    results = q.run_suite(df, q.Suite("single", constraints))
    return results.select("constraint", "metric", "constraint_status")


@query(
    _results_sql(
        [
            (
                "CompletenessConstraint(Completeness(kind,None))",
                _share("nullif(event_type, 'error') IS NOT NULL", "events"),
            )
        ],
        RESULT,
    )
)
def completeness(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    kind = F.nullif("event_type", F.lit("error")).alias("kind")
    return _result(events.select(kind), q.complete("kind"))


@query(
    _results_sql(
        [("UniquenessConstraint(Uniqueness(List(text),None))", _unique_share("text", "documents"))],
        RESULT,
    )
)
def uniqueness(spark: SparkSession, folder: str) -> DataFrame:
    return _result(table(spark, folder, "documents"), q.unique("text"))


@query(
    _results_sql(
        [
            (
                "ComplianceConstraint(Compliance(lang contained in en,fr,"
                "`lang` IS NULL OR `lang` IN ('en','fr'),None))",
                _share("lang IS NULL OR lang IN ('en', 'fr')", "documents"),
            )
        ],
        RESULT,
    )
)
def set_containment(spark: SparkSession, folder: str) -> DataFrame:
    return _result(table(spark, folder, "documents"), q.contained_in("lang", ["en", "fr"]))


def _non_negative_label(column: str) -> str:
    return (
        f"ComplianceConstraint(Compliance({column} is non-negative,"
        f"COALESCE(CAST({column} AS DECIMAL(20,10)), 0.0) >= 0,None))"
    )


def _non_negative_share(value: str, source: str) -> str:
    return _share(f"coalesce(try_cast({value} AS DECIMAL(20,10)), 0) >= 0", source)


@query(
    _results_sql(
        [(_non_negative_label("c_acctbal"), _non_negative_share("c_acctbal", "customer"))], RESULT
    )
)
def non_negative(spark: SparkSession, folder: str) -> DataFrame:
    return _result(table(spark, folder, "customer"), q.non_negative("c_acctbal"))


@query(
    _results_sql(
        [
            (_non_negative_label("p_type"), _non_negative_share("p_type", "part")),
            (_non_negative_label("shift"), _share("p_size - 25 >= 0", "part")),
        ],
        RESULT,
    )
)
def non_negative_text(spark: SparkSession, folder: str) -> DataFrame:
    """Text that is no number always passes, text that is one is judged by its value."""
    shift = (F.col("p_size") - 25).cast("string").alias("shift")
    part = table(spark, folder, "part").select("p_type", shift)
    return _result(part, q.non_negative("p_type"), q.non_negative("shift"))


DOCUMENT_SUITE = q.Suite(
    "documents",
    (
        q.complete("text"),
        q.unique("text"),
        q.contained_in("lang", ["en", "fr"]),
        q.unique("doc_id"),
        q.non_negative("n_chars"),
    ),
)
DOCUMENT_METRICS = [
    ("CompletenessConstraint(Completeness(text,None))", _share("text IS NOT NULL", "documents")),
    ("UniquenessConstraint(Uniqueness(List(text),None))", _unique_share("text", "documents")),
    (
        "ComplianceConstraint(Compliance(lang contained in en,fr,"
        "`lang` IS NULL OR `lang` IN ('en','fr'),None))",
        _share("lang IS NULL OR lang IN ('en', 'fr')", "documents"),
    ),
    ("UniquenessConstraint(Uniqueness(List(doc_id),None))", _unique_share("doc_id", "documents")),
    (_non_negative_label("n_chars"), _non_negative_share("n_chars", "documents")),
]
REPORT = """upper("check") AS "File_Name",
    upper("check") || '_TC_' || ordinal AS "Test_Case_Id",
    "constraint" AS "Test_Case", constraint_status AS "Test_Result\""""


@query(_results_sql(DOCUMENT_METRICS, "ordinal, metric"))
def dq_suite(spark: SparkSession, folder: str) -> DataFrame:
    return q.suite_metrics(table(spark, folder, "documents"), DOCUMENT_SUITE)


@query(_results_sql(DOCUMENT_METRICS, '"check", "constraint", metric, constraint_status', "documents"))
def dq_suite_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """The suite carried on over four days' loads, one of which arrives a second time, mended."""
    documents, metrics = table(spark, folder, "documents"), fresh_folder(spark, "metrics")
    part = F.pmod("doc_id", F.lit(4))
    spoilt = documents.where(part == 1).withColumn("text", F.lit("spoilt"))
    loads = [("0", documents.where(part == 0)), ("1", spoilt)]
    loads += [(str(n), documents.where(part == n)) for n in (2, 3, 1)]
    for day, load in loads:
        incremental.check_day(load, DOCUMENT_SUITE, metrics, day, buckets=8)
    results = incremental.results(spark, DOCUMENT_SUITE, metrics)
    return results.select("check", "constraint", "metric", "constraint_status")


@query(_results_sql(DOCUMENT_METRICS, '"check", "constraint", constraint_status', "documents"))
def dq_results(spark: SparkSession, folder: str) -> DataFrame:
    results = q.run_suite(table(spark, folder, "documents"), DOCUMENT_SUITE)
    return results.select("check", "constraint", "constraint_status")


@query(_results_sql(DOCUMENT_METRICS, REPORT, "documents"))
def dq_report(spark: SparkSession, folder: str) -> DataFrame:
    return q.format_report(q.run_suite(table(spark, folder, "documents"), DOCUMENT_SUITE))


RECIPE_METRICS = [
    *[
        (f"CompletenessConstraint(Completeness({name},None))", _share(condition, "documents"))
        for name, condition in (
            ("name", "source IS NOT NULL"),
            ("cookTime", "n_chars IS NOT NULL"),
            ("prepTime", "doc_id IS NOT NULL"),
            ("ingredients", "text IS NOT NULL"),
            ("image", "nullif(lang, 'fr') IS NOT NULL"),
            ("url", "doc_id IS NOT NULL"),
        )
    ],
    *[
        (f"UniquenessConstraint(Uniqueness(List({name}),None))", _unique_share(column, "documents"))
        for name, column in (("name", "source"), ("ingredients", "text"), ("url", "doc_id"))
    ],
]


@query(_results_sql(RECIPE_METRICS, REPORT, "recipe"))
def dq_suite_wide(spark: SparkSession, folder: str) -> DataFrame:
    """The recipe suite, looked up by dataset name."""
    suite = q.suite_for("data_quality_files|recipe_data|Recipe")
    return q.format_report(q.run_suite(document_recipes(spark, folder), suite))


AVERAGE_METRICS = [
    (
        "CompletenessConstraint(Completeness(difficulty,None))",
        _share("difficulty IS NOT NULL", "a"),
    ),
    (
        "CompletenessConstraint(Completeness(avg_total_cooking_time,None))",
        _share("avg_total_cooking_time IS NOT NULL", "a"),
    ),
    (
        "ComplianceConstraint(Compliance(difficulty contained in easy,medium,hard,"
        "`difficulty` IS NULL OR `difficulty` IN ('easy','medium','hard'),None))",
        _share("difficulty IS NULL OR difficulty IN ('easy', 'medium', 'hard')", "a"),
    ),
    ("UniquenessConstraint(Uniqueness(List(difficulty),None))", _unique_share("difficulty", "a")),
    (
        _non_negative_label("avg_total_cooking_time"),
        _non_negative_share("avg_total_cooking_time", "a"),
    ),
]


@query(f"WITH a AS ({FLAGSHIP_SQL}) " + _results_sql(AVERAGE_METRICS, REPORT, "recipe_aggregate"))
def dq_suite_aggregate(spark: SparkSession, folder: str) -> DataFrame:
    """The suite of the aggregated result, run on the flagship's result."""
    rows = event_recipes(spark, folder)
    result = rows.transform(recipes.recipe_difficulty, keyword=EVENT_KEYWORD)
    return q.format_report(q.run_suite(result, q.suite_for("recipe_aggregate")))


@query(_results_sql(RECIPE_METRICS, REPORT, "recipe"))
def quality_job(spark: SparkSession, folder: str) -> DataFrame:
    """The whole checking job: JSON lines in, CSV report out."""
    arrived, report = fresh_folder(spark, "recipes"), fresh_folder(spark, "report")
    write_files(document_recipes(spark, folder), arrived, "json")
    job.run(spark, "recipe", arrived, report, persist=True)
    return read_files(spark, "csv", report, VALIDATION_REPORT)


def _more(column: str, name: str, predicate: str) -> str:
    return (
        f"ComplianceConstraint(Compliance({column} {name},"
        f"`{column}` IS NULL OR {predicate},None))"
    )


MORE_METRICS = [
    (
        "ComplianceConstraint(Compliance(never is null,`never` IS NULL,None))",
        _share("p_size > 25", "part"),
    ),
    ("CompletenessConstraint(Completeness(p_name,None))", _share("p_name IS NOT NULL", "part")),
    (
        "ComplianceConstraint(Compliance(p_type contained in ECONOMY,SMALL,"
        "`p_type` IS NULL OR `p_type` IN ('ECONOMY','SMALL'),None))",
        _share("p_type IN ('ECONOMY', 'SMALL')", "part"),
    ),
    (
        _more("p_size", "between 10 and 40", "`p_size` BETWEEN 10 AND 40"),
        _share("p_size BETWEEN 10 AND 40", "part"),
    ),
    (
        _more("p_type", "is upper case", "`p_type` = UPPER(`p_type`)"),
        _share("p_type = upper(p_type)", "part"),
    ),
    (
        _more("p_brand", "is lower case", "`p_brand` = LOWER(`p_brand`)"),
        _share("p_brand = lower(p_brand)", "part"),
    ),
    (
        _more("padded", "is trimmed", "`padded` = TRIM(`padded`)"),
        _share("p_type <> 'ECONOMY'", "part"),
    ),
    (
        _more("p_retailprice", "less than 950", "`p_retailprice` < 950"),
        _share("p_retailprice < 950", "part"),
    ),
    (
        _more("p_size", "greater than 5", "`p_size` > 5"),
        _share("p_size > 5", "part"),
    ),
]


@query(_results_sql(MORE_METRICS, RESULT))
def dq_more_checks(spark: SparkSession, folder: str) -> DataFrame:
    economy = F.when(F.col("p_type") == "ECONOMY", " ").otherwise("")
    part = table(spark, folder, "part").withColumns(
        {"never": F.when(F.col("p_size") <= 25, F.col("p_name")), "padded": F.concat("p_type", economy)}
    )
    return _result(
        part,
        q.is_null("never"),
        q.complete("p_name"),
        q.contained_in("p_type", ["ECONOMY", "SMALL"]),
        q.in_range("p_size", 10, 40),
        q.upper_case("p_type"),
        q.lower_case("p_brand"),
        q.trimmed("padded"),
        q.less_than("p_retailprice", 950),
        q.greater_than("p_size", 5),
    )


def _verdict_sql(stage: str, metrics: list[tuple[str, str]]) -> str:
    failures = f"count(*) FILTER (WHERE {_status('metric')} = 'Failure')"
    return f"""SELECT '{stage}' AS stage, count(*) AS constraints, {failures} AS failures,
        CASE WHEN {failures} = 0 THEN 'pass' ELSE 'stop' END AS verdict
        FROM ({_results_sql(metrics, "metric")}) AS r"""


@query(
    f"WITH a AS ({FLAGSHIP_SQL}) "
    + _verdict_sql("input", DOCUMENT_METRICS)
    + " UNION ALL "
    + _verdict_sql("output", AVERAGE_METRICS)
    + " UNION ALL SELECT 'nothing', 0, 0, 'empty'"
)
def quality_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Verdicts on an input that has failures, a result that has none, and a result without rows."""
    result = event_recipes(spark, folder).transform(
        recipes.recipe_difficulty, keyword=EVENT_KEYWORD
    )
    before = q.verdict(table(spark, folder, "documents"), DOCUMENT_SUITE, "input")
    after = q.verdict(result, q.suite_for("recipe_aggregate"), "output")
    no_rows = event_recipes(spark, folder).transform(recipes.recipe_difficulty, keyword="no such word")
    nothing = q.verdict(no_rows, q.suite_for("recipe_aggregate"), "nothing")
    return before.unionByName(after).unionByName(nothing)


def _profile_sql(column: str, source: str, by: str = "") -> str:
    return f"""SELECT {by}'{column}' AS "column", count({column}) AS n,
        round(avg({column}), 6) AS mean, round(quantile_cont({column}, 0.5), 6) AS median,
        CAST(min({column}) AS DOUBLE) AS "min", CAST(max({column}) AS DOUBLE) AS "max"
        FROM {source} {"GROUP BY ALL" if by else ""}"""


def _rounded(df: DataFrame) -> DataFrame:
    """Averages of fractions depend on the order of addition in their last digits."""
    return df.withColumns({name: F.round(name, 6) for name in ("mean", "median")})


@query(_profile_sql("value", "events", "event_type, "))
def column_profile(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    return profile.column_profile(events, ["value"], ["event_type"]).transform(_rounded)


LINE_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_orderkey")
# In hundredths the sums are whole numbers, exact in whatever order they are added.
HUNDREDTHS = ", ".join(f"round({c} * 100) AS {c}" for c in LINE_MEASURES)


@query(
    f"WITH l AS (SELECT {HUNDREDTHS} FROM lineitem) "
    + " UNION ALL ".join(_profile_sql(c, "l") for c in LINE_MEASURES)
)
def table_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Several columns of a whole table at once."""
    hundredths = [F.round(F.col(c) * 100).alias(c) for c in LINE_MEASURES]
    lines = table(spark, folder, "lineitem").select(*hundredths)
    return profile.column_profile(lines, LINE_MEASURES).transform(_rounded)


#: Beyond 2 to the power of 53, where a double no longer holds every whole number.
LARGE = 2**60


def _extent_sql(column: str, kind: str, value: str) -> str:
    return f"""SELECT event_type, '{column}' AS "column", '{kind}' AS type, count({value}) AS n,
        CAST(min({value}) AS VARCHAR) AS least, CAST(max({value}) AS VARCHAR) AS greatest
        FROM events GROUP BY event_type"""


@query(
    " UNION ALL ".join(
        [
            _extent_sql("large", "bigint", f"({LARGE} + event_id)"),
            _extent_sql("day", "date", "CAST(ts AS DATE)"),
            _extent_sql("name", "string", "(event_type || user_id)"),
        ]
    )
)
def extent_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Least and greatest of large whole numbers, dates and text by event type."""
    events = table(spark, folder, "events").select(
        "event_type",
        (F.lit(LARGE) + F.col("event_id")).alias("large"),
        F.to_date("ts").alias("day"),
        F.concat("event_type", "user_id").alias("name"),
    )
    return profile.extents(events, ["large", "day", "name"], ["event_type"])
