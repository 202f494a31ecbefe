import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from larder.operators.quarantine import quarantined, tag_reason, usable
from larder.schemas import CORRUPT_COLUMN, RECIPE, RECIPE_AGGREGATE, with_corrupt_column
from larder.sources import (
    fresh_folder,
    land_by_partition,
    preprocess_recipes,
    read_arrival_day,
    read_days,
    read_files,
    read_json_lines,
    read_landed,
    write_files,
)
from larder.sources.workspace import shared_folder
from tests.cookbook import DISHES, row, rows, write_json


def test_json_lines_from_several_files(spark, tmp_path):
    write_json(tmp_path / "in", rows()[:4], "one.json")
    folder = write_json(tmp_path / "in", rows()[4:], "two.json")
    df = read_json_lines(spark, folder, RECIPE)
    assert df.schema == RECIPE
    assert df.count() == len(DISHES)


def test_json_lines_infer_the_same_columns(spark, tmp_path):
    folder = write_json(tmp_path / "in", rows())
    inferred = read_json_lines(spark, folder)
    assert sorted(inferred.columns) == sorted(RECIPE.fieldNames())
    typed = read_json_lines(spark, folder, RECIPE).select(*inferred.columns)
    assert sorted(typed.collect(), key=str) == sorted(inferred.collect(), key=str)


def test_json_schema_tolerates_other_types_and_fields(spark, tmp_path):
    folder = write_json(tmp_path / "in", ['{"name": 7, "cookTime": "PT5M", "calories": 3}'])
    got = read_json_lines(spark, folder, RECIPE).first()
    assert (got["name"], got["cookTime"], got["prepTime"]) == ("7", "PT5M", None)


def test_corrupt_line_is_kept(spark, tmp_path):
    folder = write_json(tmp_path / "in", [rows()[0], '{"name": "cut', "no json"])
    df = read_json_lines(spark, folder, RECIPE, keep_corrupt=True)
    assert df.schema == with_corrupt_column(RECIPE)
    bad = df.select("name", CORRUPT_COLUMN).where(F.col(CORRUPT_COLUMN).isNotNull()).collect()
    assert {r[CORRUPT_COLUMN] for r in bad} == {'{"name": "cut', "no json"}
    assert read_json_lines(spark, folder, RECIPE).where("name is not null").count() == 1


def test_empty_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    assert read_json_lines(spark, str(tmp_path / "in"), RECIPE).isEmpty()


def test_csv_round_trip_is_one_file_with_header(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("easy", 20.5), ("hard", None)], RECIPE_AGGREGATE).repartition(4)
    write_files(df, path, "csv", single_file=True)
    files = list((tmp_path / "out").glob("part-*.csv"))
    assert len(files) == 1
    assert files[0].read_text().splitlines()[0] == "difficulty,avg_total_cooking_time"
    back = read_files(spark, "CSV", path, RECIPE_AGGREGATE)
    assert sorted(back.collect()) == sorted(df.collect())


def test_csv_without_header(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("a", 1.0)], RECIPE_AGGREGATE)
    write_files(df, path, "csv", header=False)
    assert read_files(spark, "csv", path, RECIPE_AGGREGATE, header=False).collect() == df.collect()


def test_csv_header_must_fit_the_schema(spark, tmp_path):
    path = str(tmp_path / "out")
    write_files(spark.createDataFrame([(1.0, "a")], "avg double, level string"), path, "csv")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        read_files(spark, "csv", path, RECIPE_AGGREGATE).collect()


@pytest.mark.parametrize("file_format", ["json", "parquet", "orc"])
def test_other_formats(spark, tmp_path, file_format):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("easy", 20.5)], RECIPE_AGGREGATE)
    write_files(df, path, file_format)
    write_files(df, path, file_format)
    assert read_files(spark, file_format, path, RECIPE_AGGREGATE).collect() == df.collect()


def days(spark, *values):
    return spark.createDataFrame(
        [(i, dt.date(2019, 11, d)) for i, d in values], "id int, event_date date"
    )


def test_landing_replaces_only_the_days_at_hand(spark, tmp_path):
    path = str(tmp_path / "landed")
    land_by_partition(days(spark, (1, 28), (2, 29), (3, 29)), path, ["event_date"])
    land_by_partition(days(spark, (4, 29), (5, 30)), path, ["event_date"])
    schema = days(spark, (1, 1)).schema
    got = {tuple(r) for r in read_landed(spark, path, schema).collect()}
    assert got == {(i, dt.date(2019, 11, d)) for i, d in ((1, 28), (4, 29), (5, 30))}
    day = read_days(spark, path, dt.date(2019, 11, 29), schema=schema)
    assert [r["id"] for r in day.collect()] == [4]
    span = read_days(spark, path, dt.date(2019, 11, 28), dt.date(2019, 11, 29), schema=schema)
    assert sorted(r["id"] for r in span.collect()) == [1, 4]
    assert read_days(spark, path, dt.date(2020, 1, 1), schema=schema).isEmpty()


def test_landing_without_rebalance(spark, tmp_path):
    path = str(tmp_path / "landed")
    land_by_partition(days(spark, (1, 28), (2, 29)), path, ["event_date"], rebalance=False)
    assert read_landed(spark, path).count() == 2


def test_arrival_day(spark, tmp_path):
    write_json(tmp_path / "2019" / "11" / "28", rows()[:2])
    write_json(tmp_path / "2019" / "11" / "29", rows()[2:])
    got = read_arrival_day(spark, str(tmp_path), dt.date(2019, 11, 28), RECIPE)
    assert got.count() == 2


def test_preprocess(spark, tmp_path):
    records = [
        *rows(),
        row("Odd", "beef", "soon", "PT5M"),
        row("Late", "beef", "PT5M", None),
        '{"name": "cut',
        {**row(" Spaced ", "beef", "PT5M", "PT1.5H"), "datePublished": "unknown"},
    ]
    raw = read_json_lines(spark, write_json(tmp_path / "in", records), RECIPE, keep_corrupt=True)
    path = str(tmp_path / "landed")
    preprocess_recipes(raw, path)
    landed = read_landed(spark, path)
    kinds = dict(landed.dtypes)
    assert kinds["datePublished"] == "date"
    assert kinds["cookTimeMinutes"] == kinds["prepTimeMinutes"] == "bigint"
    good = {r["name"]: r for r in landed.where("status = 'ok'").collect()}
    assert len(good) == len(DISHES) + 1
    assert good["Spaced"]["prepTimeMinutes"] == 90
    assert good["Spaced"]["datePublished"] is None
    assert good["Stew"]["datePublished"] == dt.date(2011, 3, 7)
    assert good["Stew"]["published_year"] == 2011
    assert good["Stew"]["description"] == "Stew for four"
    bad = {r["reason"] for r in landed.where("status = 'quarantined'").collect()}
    assert bad == {"malformed cookTime", "missing prepTime", "corrupt record"}


def test_quarantine_splits_whole(spark):
    df = spark.createDataFrame(
        [(1, "PT5M", "PT5M"), (2, None, "PT5M"), (3, "PT5M", "x"), (4, "", None)],
        "id int, cookTime string, prepTime string",
    )
    bad = {r["id"]: r["reason"] for r in df.transform(quarantined).collect()}
    assert bad == {2: "missing cookTime", 3: "malformed prepTime", 4: "malformed cookTime"}
    good = df.transform(usable)
    assert good.columns == df.columns
    assert [r["id"] for r in good.collect()] == [1]


def test_further_reasons(spark):
    df = spark.createDataFrame([(1, -5), (2, 5)], "id int, n int")
    tagged = tag_reason(df, durations=(), extra={"negative n": F.col("n") < 0})
    assert {r["id"]: r["reason"] for r in tagged.collect()} == {1: "negative n", 2: None}


def session_without_folder(master):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context
    )


@pytest.mark.parametrize("master", ["yarn", "spark://head:7077", "k8s://host"])
def test_a_cluster_must_name_its_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session_without_folder(master))


def test_folders_lie_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = fresh_folder(spark, "x"), fresh_folder(spark, "x")
    assert one.startswith(shared) and two.startswith(shared) and one != two
