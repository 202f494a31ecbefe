import pytest

from larder.operators.compare import (
    latest_by_key,
    reconcile,
    reconcile_columns,
    reconcile_rows,
    snapshot_changes,
    snapshot_duplicates,
)


def as_dict(df, key):
    return {r[key]: tuple(v for k, v in r.asDict().items() if k != key) for r in df.collect()}


def test_reconcile(spark):
    schema = "k string, v bigint"
    source = spark.createDataFrame(
        [("same", 1), ("same", 2), ("sum", 1), ("count", 1), ("lost", 5), (None, 3),
         ("null", None)],
        schema,
    )
    target = spark.createDataFrame(
        [("same", 3), ("same", 0), ("sum", 2), ("count", 1), ("count", 0), ("new", 5), (None, 3),
         ("null", None)],
        schema,
    )
    assert as_dict(reconcile(source, target, ["k"], ["v"]), "k") == {
        "same": (2, 3, 2, 3, "match"),
        "sum": (1, 1, 1, 2, "mismatch"),
        "count": (1, 1, 2, 1, "mismatch"),
        "lost": (1, 5, 0, None, "missing in target"),
        "new": (0, None, 1, 5, "missing in source"),
        None: (1, 3, 1, 3, "match"),
        "null": (1, None, 1, None, "match"),
    }


def test_reconcile_counts_only(spark):
    a, b = spark.range(5), spark.range(4)
    got = reconcile(a, b, ["id"]).where("status <> 'match'").collect()
    assert [tuple(r) for r in got] == [(4, 1, 0, "missing in target")]


def test_reconcile_rows(spark):
    schema = "k int, a string, b double"
    long = "x" * 100
    source = spark.createDataFrame(
        [(1, "a", 1.0), (2, long, 1.0), (3, None, None), (4, "d", 1.0), (4, "d", 1.0)], schema
    )
    target = spark.createDataFrame(
        [(1, "a", 1.0), (2, long + "y", 1.0), (3, None, None), (4, "d", 1.0)], schema
    )
    got = reconcile_rows(source, target, ["k"], ["a", "b"])
    assert got.columns == ["k", "source_rows", "target_rows"]
    assert sorted(tuple(r) for r in got.collect()) == [(2, 0, 1), (2, 1, 0), (4, 2, 1)]


def test_reconcile_columns(spark):
    source = spark.createDataFrame([(1, "b", 1.5), (2, None, 0.5)], "k int, a string, b double")
    target = spark.createDataFrame([(2, "b", 1), (1, None, 2)], "k int, a string, c int")
    got = as_dict(reconcile_columns(source, target), "column")
    assert got == {
        "k": ("int", "2", "1", "2", "int", "2", "1", "2", "match"),
        "a": ("string", "1", "b", "b", "string", "1", "b", "b", "match"),
        "b": ("double", "2", "0.5", "1.5", None, None, None, None, "missing in target"),
        "c": (None, None, None, None, "int", "2", "1", "2", "missing in source"),
    }
    retyped = target.selectExpr("cast(k as bigint) as k", "'c' as a")
    differing = reconcile_columns(target.select("k", "a"), retyped).select("column", "status")
    assert as_dict(differing, "column") == {"k": ("mismatch",), "a": ("mismatch",)}


def test_snapshot_changes(spark):
    schema = "k int, minutes int, level string"
    before = spark.createDataFrame(
        [(1, 10, "easy"), (2, 40, "medium"), (3, None, None), (4, 20, "easy"), (6, 1, None)],
        schema,
    )
    after = spark.createDataFrame(
        [(1, 10, "easy"), (2, 70, "hard"), (3, None, None), (5, 15, "easy"), (6, 1, "easy")],
        schema,
    )
    got = as_dict(snapshot_changes(before, after, "k", ["minutes", "level"]), "k")
    assert got == {
        2: ("changed", 40, 70, "medium", "hard"),
        4: ("removed", 20, None, "easy", None),
        5: ("added", None, 15, None, "easy"),
        6: ("changed", 1, 1, None, "easy"),
    }


def test_key_with_many_rows_stands_for_one(spark):
    """A hot key on both sides gives one row, not pairs; the greatest version counts."""
    n = 2000
    before = spark.range(n).selectExpr("7 as k", "id as version", "concat('v', id % 5) as state")
    after = spark.range(n).selectExpr("7 as k", "id + 1 as version", "concat('v', id % 5) as state")
    assert snapshot_changes(before, after, "k", ["state"], ["version"]).collect() == []
    newer = spark.createDataFrame([(7, n + 9, "new")], "k int, version bigint, state string")
    got = snapshot_changes(before, newer, "k", ["state"], ["version"]).collect()
    assert [tuple(r) for r in got] == [(7, "changed", "v4", "new")]


def test_latest_by_key(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), ("b", 5, None), (None, 1, "n"), ("c", 1, "p"),
         ("c", 1, "q")],
        "k string, day int, v string",
    )
    got = as_dict(latest_by_key(df, "k", ["day"], ["v"]), "k")
    assert got == {"a": (3, "y"), "b": (5, None), None: (1, "n"), "c": (1, "q")}


@pytest.mark.parametrize("name", ["old", "new", "a.b", "c0", "__side", "source_rows ", "a`b"])
def test_any_column_name(spark, name):
    one = spark.createDataFrame([(1, 5), (2, 6)], "k int, v int").toDF(name, "rows of it")
    two = spark.createDataFrame([(1, 5), (2, 7)], "k int, v int").toDF(name, "rows of it")
    got = reconcile(one, two, [name], ["rows of it"])
    assert got.columns[0] == name
    assert {r[0]: r["status"] for r in got.collect()} == {1: "match", 2: "mismatch"}
    rows = reconcile_rows(one, two, [name], ["rows of it"])
    assert sorted(tuple(r) for r in rows.collect()) == [(2, 0, 1), (2, 1, 0)]
    changed = snapshot_changes(one, two, name, ["rows of it"])
    assert changed.columns == [name, "change", "old_rows of it", "new_rows of it"]
    assert [tuple(r) for r in changed.collect()] == [(2, "changed", 6, 7)]
    assert sorted(tuple(r) for r in latest_by_key(one.union(two), name, [], ["rows of it"]).collect()) == [
        (1, 5),
        (2, 7),
    ]
    assert {tuple(r) for r in snapshot_duplicates(one.union(one), two, name).collect()} == {
        (1, 2, 1),
        (2, 2, 1),
    }


def test_summing_dotted_names_and_columns_beside(spark):
    one = spark.createDataFrame([(1, 5)], "k int, v int").toDF("k", "a.b")
    got = reconcile_columns(one, one).collect()
    assert {r["column"]: r["status"] for r in got} == {"k": "match", "a.b": "match"}
    assert reconcile(one, one, ["k"], ["a.b"]).columns == [
        "k", "source_rows", "source_a.b", "target_rows", "target_a.b", "status"
    ]


def test_results_with_two_columns_of_one_name_are_refused(spark):
    df = spark.createDataFrame([(1, 5)], "k int, v int")
    for refused in (
        lambda: reconcile(df.toDF("status", "v"), df.toDF("status", "v"), ["status"], ["v"]),
        lambda: reconcile(df.toDF("k", "rows"), df.toDF("k", "rows"), ["k"], ["rows"]),
        lambda: snapshot_changes(df.toDF("change", "v"), df.toDF("change", "v"), "change", ["v"]),
        lambda: snapshot_duplicates(df.toDF("old_rows", "v"), df.toDF("old_rows", "v"), "old_rows"),
        lambda: latest_by_key(df, "k", ["v"], ["V"]),
    ):
        with pytest.raises(ValueError, match="rename"):
            refused()


def test_many_rows_gives_the_same(spark):
    before = spark.range(3000).selectExpr("id % 7 as k", "id as version", "id % 3 as state")
    after = spark.range(4000).selectExpr("id % 9 as k", "id as version", "id % 5 as state")
    results = [
        sorted(
            tuple(r)
            for r in snapshot_changes(before, after, "k", ["state"], ["version"], many).collect()
        )
        for many in (False, True)
    ]
    assert results[0] == results[1] != []


def test_hot_key_in_latest_by_key(spark, plan):
    """A third of all rows are changes of one thing; each task sends one row of it."""
    df = spark.range(0, 90_000, 1, 8).selectExpr(
        "if(id % 3 = 0, -1, id) as k", "id as version", "concat('v', id) as v"
    )
    got = latest_by_key(df, "k", ["version"], ["v"])
    text = plan(got)
    assert text.index("partial_max") < text.index("hashpartitioning")
    assert got.count() == 60_001
    assert [tuple(r) for r in got.where("k = -1").collect()] == [(-1, 89_997, "v89997")]
