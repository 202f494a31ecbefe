import pytest
from pyspark.sql import functions as F

from larder.operators import recipes
from larder.schemas import RECIPE
from tests.cookbook import AVERAGES, DISHES, WITH_BEEF, rows


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(rows(), RECIPE)


def test_keyword_filter(raw):
    found = {r["name"] for r in raw.transform(recipes.keyword_filter).collect()}
    assert found == {dish[0] for dish in WITH_BEEF}


def test_keyword_in_any_case_and_inside_words(spark):
    df = spark.createDataFrame(
        [("BEEF",), ("Beefsteak",), ("roastbeef",), ("be ef",), ("",), (None,)], "t string"
    )
    assert df.transform(recipes.keyword_filter, "t", "bEEf").count() == 3


def test_keyword_is_no_pattern(spark):
    df = spark.createDataFrame([("100% rye",), ("100 rye",)], "t string")
    assert df.transform(recipes.keyword_filter, "t", "0% R").count() == 1


def test_chain(raw):
    labelled = raw.transform(recipes.label_recipes)
    got = {r["name"]: (r["total_cook_time"], r["difficulty"]) for r in labelled.collect()}
    assert got == {dish[0]: (dish[4], dish[5]) for dish in WITH_BEEF}
    assert dict(labelled.dtypes)["total_cook_time"] == "bigint"


def test_minutes_are_cut_before_adding(spark):
    df = spark.createDataFrame([("PT30S", "PT30S")], "cookTime string, prepTime string")
    total = df.transform(recipes.add_minutes).transform(recipes.add_total)
    assert total.first()["total_cook_time"] == 0


def test_average(raw):
    result = raw.transform(recipes.recipe_difficulty)
    assert result.dtypes == [("difficulty", "string"), ("avg_total_cooking_time", "double")]
    got = {r["difficulty"]: r["avg_total_cooking_time"] for r in result.collect()}
    assert got == AVERAGES


def test_label_before_or_after_total(raw):
    minutes = raw.transform(recipes.add_minutes)
    one = minutes.transform(recipes.add_difficulty).transform(recipes.add_total)
    two = minutes.transform(recipes.add_total).transform(recipes.add_difficulty)
    columns = ["name", "total_cook_time", "difficulty"]
    assert sorted(one.select(columns).collect()) == sorted(two.select(columns).collect())


@pytest.mark.parametrize(
    ("total", "label"),
    [(-1, "easy"), (0, "easy"), (29, "easy"), (30, "medium"), (60, "medium"), (61, "hard")],
)
def test_bucket_limits(spark, total, label):
    df = spark.createDataFrame([(total,)], "total_cook_time bigint")
    assert df.transform(recipes.add_difficulty).first()["difficulty"] == label


@pytest.mark.parametrize("label", [None, "hard"])
def test_null_total(spark, label):
    df = spark.createDataFrame([(None,)], "total_cook_time bigint")
    got = df.transform(recipes.add_difficulty, null_label=label).first()["difficulty"]
    assert got == label


def test_other_buckets(spark):
    df = spark.createDataFrame([(v,) for v in (0.5, 1.0, 1.5, 2.0)], "v double")
    buckets = [("low", None, 1), ("mid", 1, 1.5), ("top", 1.5, None)]
    label = recipes.bucket_label(F.col("v"), buckets)
    assert [r[0] for r in df.select(label).collect()] == ["low", "mid", "mid", "top"]


def test_rows_without_label_are_not_averaged(spark):
    df = spark.createDataFrame(
        [("easy", 10), ("easy", 20), (None, None), (None, 5)],
        "difficulty string, total_cook_time bigint",
    )
    assert [tuple(r) for r in df.transform(recipes.average_by).collect()] == [("easy", 15.0)]


def test_label_of_nulls_alone_is_kept(spark):
    df = spark.createDataFrame([("hard", None)], "difficulty string, total_cook_time bigint")
    assert [tuple(r) for r in df.transform(recipes.average_by).collect()] == [("hard", None)]


def test_project(raw):
    renamed = raw.transform(recipes.project, {"title": "name", "link": "url"})
    assert renamed.columns == ["title", "link"]
    assert renamed.count() == len(DISHES)
