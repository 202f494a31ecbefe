import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from larder.operators import profile
from larder.operators.profile import column_profile, extents


def check(spark, groups):
    rows = [(g, v) for g, values in groups.items() for v in values]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {r["g"]: r for r in column_profile(df, ["v"], ["g"]).collect()}
    assert set(got) == set(groups)
    for name, values in groups.items():
        values = [v for v in values if v is not None]
        row = got[name]
        assert row["column"] == "v"
        assert row["n"] == len(values)
        if values:
            low, high = statistics.median_low(values), statistics.median_high(values)
            assert row["median"] == low * 0.5 + high * 0.5
            # Sums of large numbers that cancel out keep no small digits.
            slack = 1e-9 * max(map(abs, values))
            assert row["mean"] == pytest.approx(statistics.fmean(values), rel=1e-9, abs=slack)
            assert (row["min"], row["max"]) == (min(values), max(values))
        else:
            assert row["median"] is row["mean"] is row["min"] is row["max"] is None


def test_against_brute_force(spark):
    r = random.Random(11)
    check(
        spark,
        {
            "normal": [r.gauss(0, 1) for _ in range(2001)],
            "even": [r.gauss(5, 100) for _ in range(2000)],
            "magnitudes": [r.choice([-1, 1]) * 10 ** r.uniform(-200, 200) for _ in range(1001)],
            "outlier": [r.random() for _ in range(500)] + [1e300, -1e300],
            "ties": [float(r.randrange(4)) for _ in range(999)],
            "close": [1.0 + k * 2**-52 for k in range(300)],
            "one": [3.5],
            "two": [-7.0, 9.0],
            "zeros": [0.0, -0.0, 0.0, -0.0],
            "small": [5e-324, 1e-310, 0.0, -5e-324],
            "huge": [1.7e308, -1.6e308],
            "nulls": [None, 1.0, None, 4.0],
            "empty": [None, None],
            None: [2.0, 4.0, 9.0],
        },
    )


def test_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(profile, "_BROADCAST_BYTES", 0)
    r = random.Random(5)
    check(spark, {f"g{i}": [r.gauss(i, i + 1) for _ in range(101 + i)] for i in range(12)})


def test_not_finite(spark):
    inf = float("inf")
    df = spark.createDataFrame(
        [("a", v) for v in (-inf, -1.0, inf, inf, inf)] + [("b", 1.0), ("b", math.nan), ("b", 2.0)],
        "g string, v double",
    )
    got = {r["g"]: r["median"] for r in column_profile(df, ["v"], ["g"]).collect()}
    assert got == {"a": inf, "b": 2.0}


def test_several_columns_without_groups(spark):
    df = spark.range(1, 101).selectExpr("id", "id * 2 as twice", "cast(id as decimal(9,1)) as d")
    got = {r["column"]: tuple(r)[1:] for r in column_profile(df, ["id", "twice", "d"]).collect()}
    assert got == {
        "id": (100, 50.5, 50.5, 1.0, 100.0),
        "twice": (100, 101.0, 101.0, 2.0, 200.0),
        "d": (100, 50.5, 50.5, 1.0, 100.0),
    }


def test_empty_table(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert column_profile(df, ["v"], ["g"]).collect() == []


def test_approximate(spark):
    df = spark.range(1, 1002).selectExpr("id")
    row = column_profile(df, ["id"], exact_median=False).first()
    assert (row["n"], row["mean"], row["min"], row["max"]) == (1001, 501.0, 1.0, 1001.0)
    assert abs(row["median"] - 501) <= 1


def test_any_group_names(spark):
    df = spark.createDataFrame(
        [("x", 1, 3.0), ("x", 1, 5.0), (None, 1, 2.5), ("x", None, 9.0)],
        "n string, value int, `a b` double",
    )
    got = column_profile(df, ["a b"], ["n", "value"])
    assert got.columns == ["n", "value", "column", "n", "mean", "median", "min", "max"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == [
        ("x", 1, "a b", 2, 4.0, 4.0, 3.0, 5.0),
        ("x", None, "a b", 1, 9.0, 9.0, 9.0, 9.0),
        (None, 1, "a b", 1, 2.5, 2.5, 2.5, 2.5),
    ]


def test_size_of_ranges_counts_long_group_names(spark):
    state = spark.createDataFrame(
        [("x" * 1000, 0, False), ("y", 0, True), (None, 1, False)],
        "g string, place int, done boolean",
    )
    state = state.withColumn("held", F.lit(7))
    assert profile._open_ranges(state, ["g", "place"]) == {0: (1065, 7), 1: (65, 7)}


def test_extents_keep_types(spark):
    big = 2**60
    df = spark.createDataFrame(
        [(1, big + 3, "b", None), (1, big + 1, None, None), (None, 5, "a", None)],
        "g int, `n.n` bigint, type string, least date",
    )
    got = extents(df, ["n.n", "type", "least"], ["g"])
    assert got.columns == ["g", "column", "type", "n", "least", "greatest"]
    assert {tuple(r) for r in got.collect()} == {
        (1, "n.n", "bigint", 2, str(big + 1), str(big + 3)),
        (1, "type", "string", 1, "b", "b"),
        (1, "least", "date", 0, None, None),
        (None, "n.n", "bigint", 1, "5", "5"),
        (None, "type", "string", 1, "a", "a"),
        (None, "least", "date", 0, None, None),
    }
    assert [tuple(r) for r in extents(df.where("false"), ["n.n"]).collect()] == [
        ("n.n", "bigint", 0, None, None)
    ]
    with pytest.raises(ValueError, match="no numbers"):
        column_profile(df, ["n.n", "type"])


MIXED = {
    "normal": [random.Random(1).gauss(0, 1) for _ in range(3001)],
    "ties": [float(random.Random(2).randrange(3)) for _ in range(2000)],
    "huge": [1.7e308, -1.6e308, 1.0, 2.0, 1e-320],
    "nulls": [None, 1.0, None, 4.0],
    "two": [1.0, 9.0],
}


@pytest.mark.parametrize("by_value", [0, 4_000_000])
@pytest.mark.parametrize("room", [-0.3, 0.0, 0.004])
def test_whatever_the_sketch_says(spark, monkeypatch, by_value, room):
    """Bounds that miss the middle cost a read and no more; so does counting by bins."""
    monkeypatch.setattr(profile, "_ROOM", room)
    if not by_value:
        monkeypatch.setattr(profile, "_BY_VALUE", 40)
    monkeypatch.setattr(profile, "_SKETCH", 64)
    check(spark, MIXED)


def test_sketches_with_an_error_bracket_the_middle(spark):
    values = [math.exp(random.Random(9).gauss(0, 3)) * k for k in range(1, 20_002)]
    check(spark, {"many": values, "few": values[:7]})


@pytest.mark.parametrize(("by_value", "reads"), [(4_000_000, 2), (300, 3)])
def test_reads_are_counted(spark, monkeypatch, by_value, reads):
    monkeypatch.setattr(profile, "_BY_VALUE", by_value)
    monkeypatch.setattr(profile, "_BINS", 4)
    counter = spark.sparkContext.accumulator(0)

    def seen(value):
        counter.add(1)
        return value

    rows = spark.range(100_000, numPartitions=4).select(F.hash("id").cast("double").alias("v"))
    column_profile(rows.select(F.udf(seen, "double")("v").alias("v")), ["v"]).collect()
    assert counter.value == reads * 100_000
