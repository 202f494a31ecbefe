"""Validity intervals, tables published in one step, and states merged by bucket."""

import datetime as dt
import random
import threading

import pytest
from pyspark.sql import functions as F

from larder.operators.history import validity_history
from larder.plans import current_job, history_job, recipe_job
from larder.sources import published, read_landed
from larder.sources.published import Edition, edition, publish, read_parts, replaced, write_parts
from tests.cookbook import row, write_json

DAYS = [dt.date(2019, 11, d) for d in (1, 2, 4, 5, 9, 10)]


def plain_history(rows, days):
    """Day by day: what is seen goes on or begins, what is not seen ends."""
    held, out = {}, []
    for day in days:
        seen = {}
        for key, on, version, value in rows:
            if on == day and key is not None:
                best = (version is not None, version or 0, value is not None, value or "")
                seen[key] = max(seen.get(key, best), best)
        for key in list(held):
            if key not in seen or seen[key][2:] != held[key][1]:
                since, value = held.pop(key)
                out.append((key, since, day - dt.timedelta(days=1), value[1] if value[0] else None))
        for key, best in seen.items():
            held.setdefault(key, (day, best[2:]))
    out += [(key, since, None, value[1] if value[0] else None) for key, (since, value) in held.items()]
    return sorted(out, key=repr)


def states(seed=1):
    """Keys that change, vanish and come back; NULLs everywhere; several rows a day."""
    rng = random.Random(seed)
    rows = [("always", day, 1, "same") for day in DAYS] + [(None, DAYS[0], 1, "no key"), ("undated", None, 1, "x")]
    for number in range(60):
        for day in DAYS:
            for _ in range(rng.choice((0, 1, 1, 2))):
                rows.append((f"k{number}", day, rng.choice((None, 1, 2)), rng.choice((None, "a", "b"))))
    return rows


def test_history_equals_a_walk_over_the_days(spark):
    rows = states()
    df = spark.createDataFrame(rows, "`a.key` string, day date, version int, `the value` string")
    got = validity_history(df.repartition(7), "a.key", "day", ["the value"], ["version"])
    assert got.columns == ["a.key", "valid_from", "valid_to", "the value"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_history(rows, DAYS)


def test_history_of_nothing_and_clashing_names(spark):
    df = spark.createDataFrame([], "key string, day date, valid_to string")
    assert validity_history(df, "key", "day", []).collect() == []
    with pytest.raises(ValueError, match="valid_to"):
        validity_history(df, "key", "day", ["valid_to"])


def test_a_hot_key_is_reduced_before_the_shuffle(spark, plan):
    df = spark.range(1000).select(
        F.lit("hot").alias("key"), F.lit(DAYS[0]).alias("day"), F.col("id").alias("version"), F.lit("v").alias("v")
    )
    got = validity_history(df, "key", "day", ["v"], ["version"])
    assert [tuple(r) for r in got.collect()] == [("hot", DAYS[0], None, "v")]
    assert "partial_max" in plan(got)


def dumps(tmp_path, spark, days=DAYS):
    """A layer of dumps with dishes that change, go and come back, and one bad row."""
    rng = random.Random(5)
    layer = str(tmp_path / "layer")
    for day in days:
        records = [
            row(f"dish{n}", "beef", f"PT{rng.choice((10, 10, 50))}M", "PT5M", n) for n in range(40) if rng.random() < 0.8
        ]
        write_json(tmp_path / "in" / f"{day:%Y/%m/%d}", [*records, row("bad", "beef", "soon", "PT5M")])
        recipe_job.preprocess(spark, str(tmp_path / "in"), layer, day)
    return layer


def content(df):
    return sorted(map(repr, df.collect()))


def test_history_by_day_equals_history_at_once(spark, tmp_path):
    layer, history = dumps(tmp_path, spark), str(tmp_path / "history")
    for day in DAYS:
        for _ in range(2 if day == DAYS[3] else 1):  # a day merged twice counts once
            history_job.main(["--layer", layer, "--history", history, "--day", str(day)])
    whole = history_job.history_of_layer(spark, layer)
    got = history_job.read_history(spark, history)
    assert content(got.select(whole.columns)) == content(whole)
    until = history_job.tracked_states(read_landed(spark, layer)).where(F.col("execution_date") <= DAYS[2])
    early = validity_history(until, "url", "execution_date", history_job.TRACKED, history_job.VERSION)
    # A day without a dump shows the state of the last one before it.
    for day in (DAYS[2], DAYS[2]):
        assert content(history_job.read_history(spark, history, day).select(early.columns)) == content(early)
    assert history_job.read_history(spark, history, DAYS[4] - dt.timedelta(days=1)).count() > early.count()
    with pytest.raises(ValueError, match="no history up to"):
        history_job.read_history(spark, history, DAYS[0] - dt.timedelta(days=1))
    with pytest.raises(ValueError, match="no usable rows"):
        history_job.merge_day(spark, layer, history, dt.date(2020, 1, 1))


def test_ended_intervals_are_written_once(spark, tmp_path):
    layer, history = dumps(tmp_path, spark, DAYS[:3]), str(tmp_path / "history")
    for day in DAYS[:3]:
        history_job.merge_day(spark, layer, history, day)
    two, three = (edition(spark, history, until=str(day)) for day in DAYS[1:3])
    ended = two.of(history_job.ENDED)
    assert ended and ended.items() <= three.of(history_job.ENDED).items()


def files(root):
    return {str(p) for p in root.rglob("*.parquet")}


def test_a_day_rewrites_the_buckets_it_touches(spark, tmp_path):
    first, second = dt.date(2019, 11, 28), dt.date(2019, 11, 29)
    dishes = [row(f"dish{n}", "beef", "PT1H", "PT5M", n) for n in range(400)]
    layer, current = str(tmp_path / "layer"), tmp_path / "current"
    for day, records in ((first, dishes), (second, [{**dishes[7], "cookTime": "PT2H"}])):
        write_json(tmp_path / "in" / f"{day:%Y/%m/%d}", records)
        recipe_job.preprocess(spark, str(tmp_path / "in"), layer, day)
    current_job.merge_day(spark, layer, str(current), first, buckets=100)
    before, held = files(current), edition(spark, str(current)).of(current_job.ROWS)
    current_job.merge_day(spark, layer, str(current), second)
    after, now = files(current), edition(spark, str(current)).of(current_job.ROWS)
    assert len(held) > 90 and before <= after and len(after - before) == 1
    assert sum(now[part] != held[part] for part in held) == 1 and now.keys() == held.keys()

    def minutes(day):
        return {r["url"]: r["cookTimeMinutes"] for r in current_job.read_current(spark, str(current), day).collect()}

    assert set(minutes(first).values()) == {60}
    changed = dict(minutes(first)) | {dishes[7]["url"]: 120}
    assert minutes(second) == minutes(None) == changed
    # The first state goes, with the one bucket that only it names.
    assert len(published.drop_editions(spark, str(current), keep=1)) == 1
    assert minutes(None) == changed and len(files(current)) == len(before)
    with pytest.raises(ValueError, match="no state up to"):
        current_job.read_current(spark, str(current), first)
    with pytest.raises(ValueError, match="at least one"):
        published.drop_editions(spark, str(current), keep=0)


def publish_rows(spark, root, label, values, part=None):
    df = spark.createDataFrame([(v,) for v in values], "value long")
    base = edition(spark, root)
    made = write_parts(df, root, label, F.lit("all") if part is None else part)
    publish(spark, root, replaced(base, label, "rows", made, df.schema, ["all"]))


def values(spark, root):
    return sorted(r["value"] for r in read_parts(spark, root, edition(spark, root), "rows").collect())


def test_a_load_that_dies_leaves_the_old_table(spark, tmp_path):
    root = str(tmp_path / "table")
    publish_rows(spark, root, "1", [1, 2])
    dying = F.when(F.col("value") == 4, F.raise_error(F.lit("lost"))).otherwise(F.lit("all"))
    with pytest.raises(Exception, match="lost"):
        publish_rows(spark, root, "2", [3, 4, 5], dying)
    assert values(spark, root) == [1, 2] and published.labels(spark, root) == ["1"]
    # Files are written, but the load dies before it is published.
    write_parts(spark.range(3).withColumnRenamed("id", "value"), root, "2", F.lit("all"))
    assert values(spark, root) == [1, 2]
    publish_rows(spark, root, "2", [6])
    assert values(spark, root) == [6]
    # What the dead loads and the old edition left behind goes.
    published.drop_editions(spark, root, keep=1)
    assert values(spark, root) == [6] and len(list((tmp_path / "table" / "data").iterdir())) == 1


def test_readers_meet_whole_editions_only(spark, tmp_path):
    root = str(tmp_path / "table")
    publish_rows(spark, root, "0", [0] * 5)
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            seen.append(values(spark, root))

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(1, 6):
        publish_rows(spark, root, str(n), [n] * 5)
    stop.set()
    reader.join()
    assert seen and all(len(got) == 5 and len(set(got)) == 1 for got in seen)
    assert values(spark, root) == [5] * 5


def test_editions_are_never_replaced(spark, tmp_path):
    root = str(tmp_path / "table")
    assert edition(spark, root) is None and published.labels(spark, root) == []
    publish(spark, root, Edition("a", facts={"n": 1}))
    publish(spark, root, Edition("a", facts={"n": 2}))
    publish(spark, root, Edition("b"))
    assert edition(spark, root, until="a").facts == {"n": 2} and edition(spark, root).label == "b"
    assert edition(spark, root, before="b").facts == {"n": 2} and edition(spark, root, before="a") is None
    from larder.sources import store

    with pytest.raises(FileExistsError):
        store.write_new(spark, f"{root}/editions/00000000~a", "again")
    assert edition(spark, root, until="a").facts == {"n": 2}


def test_parts_without_rows_are_gone(spark, tmp_path):
    root = str(tmp_path / "table")
    publish_rows(spark, root, "1", [1])
    publish_rows(spark, root, "2", [])
    assert values(spark, root) == [] and edition(spark, root).of("rows") == {}
    with pytest.raises(ValueError, match="rename"):
        write_parts(spark.range(1).withColumnRenamed("id", "Part"), root, "3", F.lit("x"))
