"""Suites carried on day by day, and reconciliation by checksums."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from larder import quality as q
from larder.operators import compare
from larder.quality import incremental
from larder.quality.suite import RESULTS
from larder.sources.published import edition
from tests.test_drift import nodes

SHAPE = "name string, code binary, size double, day date, n long"
SUITE = q.Suite(
    "things",
    (
        q.complete("name"),
        q.unique("name"),
        q.unique("code"),
        q.non_negative("n"),
        q.unique("size"),
        q.contained_in("name", ["a", "b"]),
        q.unique("day"),
    ),
)


def load(spark, seed, rows=80):
    rng = random.Random(seed)
    made = [
        (
            rng.choice([None, "", "a", "x" * 40, *(f"name {i}" for i in range(60))]),
            rng.choice([None, *(bytes([i]) * rng.choice((1, 40)) for i in range(90))]),
            rng.choice([None, 0.0, -0.0, float("nan"), rng.random()]),
            rng.choice([None, dt.date(2024, 1, rng.randrange(1, 28))]),
            rng.randrange(-1, 9),
        )
        for _ in range(rows)
    ]
    return spark.createDataFrame(made, SHAPE)


def results(df):
    return sorted(map(repr, df.collect()))


def test_days_add_up_to_the_suite_over_all(spark, tmp_path):
    path = str(tmp_path / "metrics")
    assert results(incremental.results(spark, SUITE, path)) == []
    loads = {}
    # A day again, a day that loses all its rows, and one that has none to begin with.
    for day, seed, rows in (("1", 1, 80), ("2", 2, 80), ("3", 3, 0), ("1", 4, 60), ("4", 5, 9), ("2", 0, 0), ("5", 4, 60)):
        loads[day] = load(spark, seed, rows)
        incremental.check_day(loads[day], SUITE, path, day, buckets=4)
        whole = spark.createDataFrame([], SHAPE)
        for df in loads.values():
            whole = whole.unionByName(df)
        assert results(incremental.results(spark, SUITE, path)) == results(q.run_suite(whole, SUITE))
    assert incremental.days_taken(spark, path) == ["1", "2", "3", "4", "5"]
    found = edition(spark, path)
    assert sum(n for n, _ in (held[0] for held in found.facts["keys"].values())) == whole.where("name is not null").count()


def test_a_column_of_nulls_and_a_suite_without_unique_columns(spark, tmp_path):
    empty = load(spark, 1).select([F.lit(None).cast(t).alias(n) for n, t in load(spark, 1, 0).dtypes])
    for name, suite in (("nulls", SUITE), ("flat", q.Suite("flat", SUITE.constraints[:1]))):
        path = str(tmp_path / name)
        incremental.check_day(empty, suite, path, "1")
        assert results(incremental.results(spark, suite, path)) == results(q.run_suite(empty, suite))


def test_what_is_refused(spark, tmp_path):
    path = str(tmp_path / "metrics")
    incremental.check_day(load(spark, 1, 5), SUITE, path, "1")
    with pytest.raises(ValueError, match="another suite"):
        incremental.check_day(load(spark, 1, 5), q.Suite("other", SUITE.constraints[:2]), path, "2")
    nested = spark.createDataFrame([([1],)], "name array<int>")
    with pytest.raises(ValueError, match="single values"):
        incremental.check_day(nested, q.Suite("n", (q.unique("name"),)), str(tmp_path / "n"), "1")
    folded = spark.createDataFrame([("a",)], "name string").select(F.collate("name", "UTF8_LCASE").alias("name"))
    with pytest.raises(ValueError, match="collation"):
        incremental.check_day(folded, q.Suite("n", (q.unique("name"),)), str(tmp_path / "c"), "1")


def test_no_result_reads_data(spark, tmp_path):
    path = str(tmp_path / "metrics")
    incremental.check_day(load(spark, 1), SUITE, path, "1")
    got = incremental.results(spark, SUITE, path, "check")
    assert got.schema.simpleString() == spark.createDataFrame([], RESULTS).schema.simpleString()
    assert {r["check"] for r in got.collect()} == {"check"}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan


KEYS, COLUMNS = ["id", "`odd`".strip("`")], ["text", "amount"]


def side(spark, rows):
    return spark.createDataFrame(rows, "id long, odd string, text string, amount double")


def rows_of(n, seed=1):
    rng = random.Random(seed)
    return [
        (rng.choice([None, i % 50]), rng.choice([None, "k", "l"]), rng.choice([None, "", "t" * 50, f"t{i}"]), rng.choice([None, 0.0, 1.5]))
        for i in range(n)
    ]


def content(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("buckets", [1, 8, 1024])
def test_digests_find_what_rows_find(spark, buckets):
    rows = rows_of(400)
    changed = [*rows[3:], (7, "k", "new", None), rows[50], rows[50], (None, None, None, None)]
    changed[10] = (*changed[10][:2], None if changed[10][2] is not None else "", changed[10][3])
    one, two = side(spark, rows).repartition(3), side(spark, changed).repartition(5)
    for a, b in ((one, two), (two, one), (one, one), (one, one.where("false")), (one.where("false"), one.where("false"))):
        got = compare.reconcile_by_digest(a, b, KEYS, COLUMNS, buckets=buckets, split=16)
        assert content(got) == content(compare.reconcile_rows(a, b, KEYS, COLUMNS))


def test_nulls_that_change_places_are_a_difference(spark):
    one, two = side(spark, [(1, "x", None, None)]), side(spark, [(1, None, "x", None)])
    got = compare.reconcile_by_digest(one, two, ["id"], ["odd", "text"])
    assert content(got) == content(compare.reconcile_rows(one, two, ["id"], ["odd", "text"])) != []


def shuffled_rows(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    return sum(n.metrics().apply("shuffleRecordsWritten").value() for n in nodes(plan) if n.nodeName() == "Exchange")


def test_equal_sides_shuffle_a_row_a_bucket(spark):
    rows = spark.range(20_000, numPartitions=2).select("id", F.lit("k").alias("odd"), F.lit("t").alias("text"), F.lit(1.0).alias("amount"))
    sides = [compare._contents(rows, KEYS, COLUMNS) for _ in range(2)]
    totals = compare._differing(*sides, F.pmod("hash", F.lit(16)))
    assert shuffled_rows(totals) == 2 * 2 * 16
    assert compare.reconcile_by_digest(rows, rows, KEYS, COLUMNS, buckets=16).collect() == []


def test_clashing_names_are_refused(spark):
    one = spark.createDataFrame([(1, 2)], "source_rows long, v long")
    with pytest.raises(ValueError, match="source_rows"):
        compare.reconcile_by_digest(one, one, ["source_rows"], ["v"])
