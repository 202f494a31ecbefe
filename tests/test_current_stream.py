"""Streams that keep the newest version of each thing, and streams into the typed layer."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from larder.operators.recipes import label_recipes
from larder.quality import enforce, run_suite, suite_for
from larder.schemas import RECIPE
from larder.sources import published
from larder.sources.layer import arrival_day, publish_day, read_layer
from larder.streaming import (
    current_average,
    latest_average,
    stream_average,
    stream_current_average,
    stream_files,
    stream_to_layer,
)
from larder.streaming import current as current_module
from tests.cookbook import AVERAGES, row, rows, write_json

SHAPE = "key string, at long, difficulty string, total_cook_time long"
DAY = dt.date(2019, 11, 29)


def write_versions(folder, records, name):
    folder.mkdir(parents=True, exist_ok=True)
    names = [part.split()[0] for part in SHAPE.split(", ")]
    lines = [json.dumps(dict(zip(names, record, strict=True))) for record in records]
    (folder / name).write_text("\n".join(lines) + "\n")


def plain_average(records):
    newest = {}
    for key, *version in records:
        if key is not None:
            best = tuple((v is not None, v if v is not None else 0) for v in version)
            newest[key] = max(newest.get(key, best), best)
    held = {}
    for _, (has_group, group), (has_value, value) in newest.values():
        if has_group and has_value:
            held.setdefault(group, []).append(value)
    return {group: sum(values) / len(values) for group, values in held.items()}


def averages(spark, path):
    return {r[0]: r[1] for r in current_average(spark, path).collect()}


def versions(seed=3, n=120):
    """Few keys with many versions, out of order; some without group, value, key or version."""
    rng = random.Random(seed)
    return [
        (
            rng.choice([None, *(f"k{i}" for i in range(9))]),
            rng.choice([None, *range(40)]),
            rng.choice([None, "easy", "medium", "hard"]),
            rng.choice([None, *range(100)]),
        )
        for _ in range(n)
    ]


@pytest.fixture
def run(spark, tmp_path):
    def go(progress="progress", **options):
        stream = stream_files(spark, str(tmp_path / "in"), _schema(spark), files_per_batch=2)
        path, checkpoint = str(tmp_path / "state"), str(tmp_path / progress)
        stream_current_average(stream, path, checkpoint, "key", ["at"], buckets=4, **options)
        return path

    return go


def _schema(spark):
    return spark.createDataFrame([], SHAPE).schema


def test_newest_versions_count_whatever_the_order(spark, tmp_path, run):
    records = versions()
    for i in range(6):
        write_versions(tmp_path / "in", records[20 * i : 20 * i + 20], f"{i}.json")
    path = run()
    assert averages(spark, path) == plain_average(records)
    assert published.labels(spark, path) == [f"{n:012d}" for n in range(3)]
    # Nothing new changes nothing; an edit takes the old version out, also into no group.
    run()
    edits = [("k1", 90, "easy", 7), ("k2", 91, None, 5), ("k3", 0, "hard", 1), ("new", None, "easy", 1)]
    write_versions(tmp_path / "in", edits, "late.json")
    run()
    assert averages(spark, path) == plain_average(records + edits)


def test_a_replayed_batch_counts_once(spark, tmp_path, run):
    records = versions(seed=4)
    for i in range(4):
        write_versions(tmp_path / "in", records[30 * i : 30 * i + 30], f"{i}.json")
    path = run()
    before = averages(spark, path)
    progress = tmp_path / "progress" / "commits"
    for name in ("1", ".1.crc"):
        (progress / name).unlink(missing_ok=True)
    run()
    assert (progress / "1").exists()
    assert averages(spark, path) == before == plain_average(records)


def test_a_batch_that_dies_before_it_is_published_is_done_again(spark, tmp_path, run, monkeypatch):
    records = versions(seed=5, n=40)
    write_versions(tmp_path / "in", records[:20], "0.json")
    path = run()
    before = averages(spark, path)
    write_versions(tmp_path / "in", records[20:], "1.json")
    with monkeypatch.context() as patch:
        patch.setattr(current_module, "publish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(Exception, match="lost"):
            run()
    assert averages(spark, path) == before == plain_average(records[:20])
    run()
    assert averages(spark, path) == plain_average(records)


def test_a_batch_rewrites_the_buckets_it_touches(spark, tmp_path, run):
    write_versions(tmp_path / "in", [(f"k{i}", 1, "easy", i) for i in range(50)], "0.json")
    path = run()
    held = published.edition(spark, path).of("newest")
    write_versions(tmp_path / "in", [("k7", 2, "easy", 0)], "1.json")
    run()
    now = published.edition(spark, path).of("newest")
    assert len(held) == 4 and sum(held[part] != now[part] for part in held) == 1


def test_results_of_another_checkpoint_are_refused(spark, tmp_path, run):
    write_versions(tmp_path / "in", versions()[:5], "0.json")
    run()
    with pytest.raises(ValueError, match="another checkpoint"):
        run(progress="other")
    folder = write_json(tmp_path / "recipes", rows())
    results = str(tmp_path / "results")

    def average(progress):
        stream = stream_files(spark, folder, RECIPE).transform(label_recipes)
        stream_average(stream, results, str(tmp_path / progress))

    average("one")
    with pytest.raises(ValueError, match="another checkpoint"):
        average("two")
    average("one")
    assert {r[0]: r[1] for r in latest_average(spark, results).collect()} == AVERAGES


def test_before_the_first_batch_there_is_no_row(spark, tmp_path):
    got = current_average(spark, str(tmp_path / "none"), "level", "mean")
    assert got.columns == ["level", "mean"] and got.collect() == []


def batch_of(spark, records):
    return spark.createDataFrame([tuple(r.get(n) for n in RECIPE.fieldNames()) for r in records], RECIPE)


def test_a_day_is_published_after_its_checks(spark, tmp_path):
    layer = str(tmp_path / "layer")

    def check(loaded):
        enforce(run_suite(loaded, suite_for("recipe")), "layer")

    unique = [row(f"dish{n}", f"beef {n}", "PT1H", "PT5M", n) for n in range(4)]
    publish_day(batch_of(spark, unique), layer, DAY, check)
    with pytest.raises(Exception, match="name"):
        publish_day(batch_of(spark, unique[:1] * 2), layer, DAY, check)
    assert read_layer(spark, layer, DAY).count() == 4
    with pytest.raises(ValueError, match="no rows"):
        publish_day(batch_of(spark, []), layer, DAY)
    publish_day(batch_of(spark, unique[:1]), layer, DAY + dt.timedelta(days=1), check)
    publish_day(batch_of(spark, unique[:2]), layer, DAY, check)
    assert read_layer(spark, layer, DAY).count() == 2 and read_layer(spark, layer).count() == 3
    assert read_layer(spark, layer, DAY, DAY + dt.timedelta(days=1)).count() == 3
    assert read_layer(spark, layer, dt.date(2020, 1, 1)).collect() == []
    with pytest.raises(ValueError, match="no day"):
        read_layer(spark, str(tmp_path / "nothing"))


def test_streams_and_loads_share_a_layer(spark, tmp_path):
    source, layer, progress = tmp_path / "in", str(tmp_path / "layer"), tmp_path / "progress"
    days = [DAY, DAY + dt.timedelta(days=1)]
    for n, day in enumerate((*days, *days)):
        folder = source / f"{day:%Y/%m/%d}"
        write_json(folder, rows()[3 * n : 3 * n + 3], f"{n}.json")
    write_json(source / "2019" / "11" / "99", [row("Odd", "beef", "PT1H", "PT1M")])

    def run():
        stream = stream_files(spark, f"{source}/*/*/*", RECIPE, files_per_batch=2)
        stream_to_layer(stream, layer, str(progress), arrival_day())

    run()
    for name in ("1", ".1.crc"):  # the stream dies before it notes its second batch
        (progress / "commits" / name).unlink(missing_ok=True)
    run()
    assert read_layer(spark, layer).count() == 13 - 2  # the fourth file has one row
    assert read_layer(spark, layer, days[0]).count() == 6
    assert read_layer(spark, layer).where("execution_date is null").count() == 1
    # A load replaces what the stream added to its day; the stream adds to it again.
    publish_day(batch_of(spark, rows()[:1]), layer, days[0])
    assert read_layer(spark, layer, days[0]).count() == 1
    write_json(source / f"{days[0]:%Y/%m/%d}", rows()[:2], "more.json")
    run()
    assert read_layer(spark, layer, days[0]).count() == 3
    assert read_layer(spark, layer, days[1]).where(F.col("status") == "ok").count() == 4
