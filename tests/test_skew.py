"""One key, day or value holding a third of all rows must not change results or crowd one task."""

import pytest
from pyspark.sql import functions as F

from larder import quality as q
from larder.operators.compare import reconcile, reconcile_rows
from larder.operators.profile import column_profile
from larder.sources import land_by_partition, read_landed

ROWS = 90_000


@pytest.fixture(scope="module")
def skewed(spark):
    hot = F.col("id") % 3 == 0
    return spark.range(0, ROWS, 1, 8).select(
        "id",
        F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 997)).alias("key"),
        F.when(hot, F.lit(0)).otherwise(F.col("id") % 29 + 1).cast("int").alias("day"),
        F.when(hot, F.lit(7.0)).otherwise(F.col("id") / 7).alias("value"),
    )


def test_hot_day_is_written_by_several_tasks(spark, skewed, tmp_path):
    path = tmp_path / "landed"
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    try:
        land_by_partition(skewed, str(path), ["day"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {p.name: len(list(p.glob("*.parquet"))) for p in path.glob("day=*")}
    assert files["day=0"] > 2
    # The other days are not scattered over all eight tasks.
    assert sum(files.values()) < 8 * len(files) / 2
    landed = read_landed(spark, str(path), skewed.schema)
    assert landed.count() == ROWS
    assert landed.select(F.sum("id")).first()[0] == ROWS * (ROWS - 1) // 2


def test_suite(skewed):
    suite = q.Suite("s", (q.unique("key"), q.unique("id"), q.complete("key")))
    got = {r["ordinal"]: r["metric"] for r in q.suite_metrics(skewed, suite).collect()}
    assert got == {0: 0.0, 1: 1.0, 2: 1.0}


def test_hot_value_reaches_the_shuffle_as_one_row_per_task(plan, skewed):
    text = plan(q.suite_metrics(skewed, q.Suite("s", (q.unique("key"),))))
    assert text.index("partial_count") < text.index("hashpartitioning")


@pytest.mark.parametrize("limit", [0, 2**24])
def test_median_of_hot_group_and_hot_value(monkeypatch, skewed, limit):
    monkeypatch.setattr("larder.operators.profile._BROADCAST_BYTES", limit)
    group = F.when(F.col("key") == "hot", "hot").otherwise("cold").alias("g")
    got = column_profile(skewed.select(group, "value"), ["value"], ["g"]).collect()
    cold = sorted(i / 7 for i in range(ROWS) if i % 3)
    middle = len(cold) // 2
    assert {r["g"]: (r["n"], r["median"]) for r in got} == {
        "hot": (ROWS // 3, 7.0),
        "cold": (len(cold), cold[middle - 1] * 0.5 + cold[middle] * 0.5),
    }


def test_reconcile(skewed):
    less = skewed.where(~((F.col("key") == "hot") & (F.col("id") == 0)))
    got = reconcile(skewed, less, ["key"], ["id"]).where("status <> 'match'").collect()
    assert [(r["key"], r["source_rows"] - r["target_rows"]) for r in got] == [("hot", 1)]
    rows = reconcile_rows(skewed, less, ["key"], ["day", "value"]).collect()
    assert [tuple(r) for r in rows] == [("hot", ROWS // 3, ROWS // 3 - 1)]
