"""The plans are the ones wanted, not just the results."""

import datetime as dt
import re

import pytest

from __spark_entry__ import queries
from larder import quality as q
from larder.bindings.checks import DOCUMENT_SUITE
from larder.bindings.inputs import table
from larder.functions import duration_minutes
from larder.operators import recipes
from larder.operators.compare import reconcile, snapshot_changes
from larder.operators.quarantine import tag_reason
from larder.schemas import RECIPE
from larder.sources import read_days, read_json_lines, write_files
from tests.cookbook import rows, write_json

FOLDER = "/root/testdata/sf0.001"
LAZY = [
    "recipe_difficulty",
    "recipe_difficulty_text",
    "keyword_filter",
    "duration_bucket",
    "avg_by_bucket",
    "dq_suite",
    "dq_suite_wide",
    "dq_more_checks",
    "reconcile",
    "snapshot_changes",
    "quarantine",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_no_joins_no_broadcast(spark, plan, name):
    text = plan(queries()[name](spark, FOLDER))
    for node in ("Python", "Pandas", "Arrow", "Join", "Cartesian", "Broadcast", "Window"):
        assert node not in text


def count(text, node):
    return len(re.findall(rf"^.*[+:]- {node} \(", text, flags=re.M)) or len(
        re.findall(rf"^\(\d+\) {node}", text, flags=re.M)
    )


def test_flagship_scans_what_it_needs_and_shuffles_partial_sums(spark, plan):
    text = plan(queries()["recipe_difficulty"](spark, FOLDER))
    assert count(text, "Exchange") == 1
    assert "partial_avg" in text
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in text
    assert "PushedFilters: [IsNotNull(event_type)]" in text


def test_durations_are_parsed_once(spark, plan, tmp_path):
    raw = read_json_lines(spark, write_json(tmp_path / "in", rows()), RECIPE)
    text = plan(raw.transform(recipes.recipe_difficulty), "extended")
    physical = text[text.index("== Physical Plan ==") :]
    assert physical.count("RLIKE(") == 2
    schema = re.search(r"ReadSchema: struct<([^>]*)>", physical).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"ingredients", "cookTime", "prepTime"}


def test_generated_code_stays_compilable(spark, plan, tmp_path):
    """The JVM leaves methods of 8,000 bytes and more to the interpreter."""
    write_files(spark.createDataFrame(rows(), RECIPE), str(tmp_path / "in"), "parquet")
    raw = spark.read.parquet(str(tmp_path / "in"))
    # Adaptive plans show no code before they run.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (
            raw.transform(recipes.recipe_difficulty),
            raw.transform(recipes.label_recipes, wrap_days=True),
            raw.select(duration_minutes("cookTime"), duration_minutes("prepTime")),
            raw.transform(tag_reason),
        ):
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", plan(df, "codegen"))]
            assert sizes and max(sizes) < 8000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_suite_scans_twice_and_shuffles_keys_once(spark, plan):
    text = plan(q.run_suite(table(spark, FOLDER, "documents"), DOCUMENT_SUITE))
    assert count(text, "Scan") == 2
    # One for the row counts, one for the keys, one for the shares per column.
    assert count(text, "Exchange") == 3
    assert "sha2" in text
    assert re.search(r"ReadSchema: struct<doc_id:bigint,text:string>", text)


def test_no_column_is_read_twice(spark, plan, tmp_path):
    write_files(spark.createDataFrame(rows(), RECIPE), str(tmp_path / "in"), "parquet")
    text = plan(q.run_suite(spark.read.parquet(str(tmp_path / "in")), q.suite_for("recipe")))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    columns = [c.split(":")[0] for scan in scans for c in scan.split(",")]
    assert sorted(columns) == sorted(q.suite_for("recipe").columns)


def test_suite_without_unique_columns_is_one_pass(spark, plan):
    suite = q.Suite("s", (q.complete("text"), q.non_negative("n_chars")))
    text = plan(q.run_suite(table(spark, FOLDER, "documents"), suite))
    assert count(text, "Scan") == 1
    assert count(text, "Exchange") == 1
    assert "SinglePartition" in text


def test_comparisons_shuffle_once(spark, plan):
    orders = table(spark, FOLDER, "orders")
    one = reconcile(orders, orders, ["o_custkey"], ["o_totalprice"])
    text = plan(one)
    assert count(text, "Exchange") == 1
    assert text.index("partial_") < text.index("hashpartitioning")
    two = snapshot_changes(orders, orders, "o_orderkey", ["o_orderstatus"])
    text = plan(two)
    assert count(text, "Exchange") == 1
    assert count(text, "Sort") == 1


def test_day_read_lists_the_days_files_alone(spark, plan, tmp_path):
    path = str(tmp_path / "landed")
    days = spark.range(4).selectExpr("id", "date_add(date'2019-11-28', int(id)) as event_date")
    write_files(days, path, "parquet", partition_by=["event_date"])
    one = read_days(spark, path, dt.date(2019, 11, 29))
    assert len(one.inputFiles()) == 1
    assert "event_date=2019-11-29" in one.inputFiles()[0]
    two = read_days(spark, path, dt.date(2019, 11, 30), dt.date(2019, 12, 5), schema=days.schema)
    assert len(two.inputFiles()) == 2
    assert two.dtypes == one.dtypes == days.dtypes
    # A condition on the day column still prunes whole folders.
    later = plan(spark.read.parquet(path).where("event_date > date'2019-11-29'"))
    assert re.search(r"PartitionFilters: \[.*event_date.*2019-11-29", later)
