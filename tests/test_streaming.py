import datetime as dt
import shutil

import pytest

from larder.operators.recipes import label_recipes
from larder.schemas import RECIPE, RECIPE_AGGREGATE
from larder.sources import read_days, read_landed, type_recipes
from larder.streaming import latest_average, stream_average, stream_files, stream_to_partitions
from larder.streaming.jobs import KEPT_RESULTS, _write_batch
from tests.cookbook import AVERAGES, row, rows, write_json


def averages(spark, path):
    result = latest_average(spark, path)
    return {r["difficulty"]: r["avg_total_cooking_time"] for r in result.collect()}


def test_average_over_batches_and_runs(spark, tmp_path):
    folder = tmp_path / "in"
    for i, record in enumerate(rows()):
        write_json(folder, [record], f"{i}.json")
    results, progress = str(tmp_path / "results"), str(tmp_path / "progress")

    def run():
        stream = stream_files(spark, str(folder), RECIPE, files_per_batch=4)
        stream_average(stream.transform(label_recipes), results, progress)

    run()
    assert averages(spark, results) == AVERAGES
    folders = {p.name for p in (tmp_path / "results").glob("slot=*")}
    assert folders == {"slot=0", "slot=1", "slot=2"}
    # Nothing new: nothing changes.
    run()
    assert averages(spark, results) == AVERAGES
    # An old recipe arriving late still counts.
    write_json(folder, [row("Roast", "beef", "PT3H", "PT0M")], "late.json")
    run()
    assert averages(spark, results)["hard"] == pytest.approx((140 + 61 + 180) / 3)


def test_results_stay_in_a_fixed_number_of_folders(spark, tmp_path):
    results = str(tmp_path / "results")
    assert latest_average(spark, results).collect() == []
    write = _write_batch(results)
    for batch in range(10):
        write(spark.createDataFrame([("easy", float(batch))], RECIPE_AGGREGATE), batch)
    assert averages(spark, results) == {"easy": 9.0}
    assert len(list((tmp_path / "results").glob("slot=*"))) == KEPT_RESULTS


def test_batch_run_again_after_a_failure(spark, tmp_path):
    """A run that dies between writing a batch and noting it done repeats that batch."""
    folder = tmp_path / "in"
    for i, record in enumerate(rows()):
        write_json(folder, [record], f"{i}.json")
    results, progress = str(tmp_path / "results"), tmp_path / "progress"
    landed, landing = str(tmp_path / "landed"), tmp_path / "landing"

    def run():
        stream = stream_files(spark, str(folder), RECIPE, files_per_batch=4)
        stream_average(stream.transform(label_recipes), results, str(progress))
        stream = stream_files(spark, str(folder), RECIPE, files_per_batch=4)
        stream_to_partitions(stream, landed, str(landing), ["datePublished"])

    run()
    for noted in (progress, landing):
        (noted / "commits" / "2").unlink()
        (noted / "commits" / ".2.crc").unlink(missing_ok=True)
    run()
    assert (progress / "commits" / "2").exists()
    assert averages(spark, results) == AVERAGES
    assert spark.read.parquet(landed).count() == len(rows())


def test_few_state_partitions_and_settings_left_alone(spark, tmp_path):
    folder = write_json(tmp_path / "in", rows())
    before = spark.conf.get("spark.sql.shuffle.partitions")
    stream = stream_files(spark, folder, RECIPE).transform(label_recipes)
    stream_average(
        stream, str(tmp_path / "results"), str(tmp_path / "progress"), state_partitions=2
    )
    state = [p.name for p in (tmp_path / "progress" / "state" / "0").iterdir()]
    assert sorted(name for name in state if name.isdigit()) == ["0", "1"]
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_landing_appends_each_row_once(spark, tmp_path):
    folder = tmp_path / "in"
    write_json(folder, rows()[:6], "a.json")
    landed, progress = str(tmp_path / "landed"), str(tmp_path / "progress")

    def run():
        stream = stream_files(spark, str(folder), RECIPE, bytes_per_batch=1024)
        stream_to_partitions(stream, landed, progress, ["datePublished"])

    run()
    run()
    write_json(folder, rows()[6:], "b.json")
    run()
    got = spark.read.parquet(landed)
    assert got.count() == got.select("url").distinct().count() == len(rows())
    assert (tmp_path / "landed" / "datePublished=2011-03-07").is_dir()


def test_interval_keeps_running(spark, tmp_path):
    folder = write_json(tmp_path / "in", rows())
    stream = stream_files(spark, folder, RECIPE)
    results = str(tmp_path / "results")
    running = stream_average(
        stream.transform(label_recipes), results, str(tmp_path / "progress"), interval="1 second"
    )
    try:
        assert running.isActive
        running.processAllAvailable()
        assert averages(spark, results) == AVERAGES
    finally:
        running.stop()


def test_day_read_leaves_uncommitted_files_out(spark, tmp_path):
    folder = write_json(tmp_path / "in", rows())
    landed = tmp_path / "landed"
    stream = stream_files(spark, folder, RECIPE)
    stream_to_partitions(stream, str(landed), str(tmp_path / "progress"), ["datePublished"])
    day = landed / "datePublished=2011-03-07"
    committed = next(day.glob("*.parquet"))
    shutil.copy(committed, day / "part-left-by-a-failed-attempt.parquet")
    whole = read_landed(spark, str(landed)).count()
    first = dt.date(2011, 3, 7)
    one = read_days(spark, str(landed), first, day_column="datePublished")
    assert one.count() == whole == len(rows())
    assert read_days(spark, str(landed), dt.date(2011, 3, 8), day_column="datePublished").count() == 0


def test_stream_keeps_the_text_of_corrupt_lines(spark, tmp_path):
    folder = write_json(tmp_path / "in", [*rows(), "no json"])
    landed = str(tmp_path / "landed")
    stream = stream_files(spark, folder, RECIPE, keep_corrupt=True).transform(type_recipes)
    stream_to_partitions(stream, landed, str(tmp_path / "progress"), ["status"])
    got = spark.read.parquet(landed)
    assert got.count() == len(rows()) + 1
    bad = got.where("status = 'quarantined'").collect()
    assert [(r["reason"], r["_corrupt_record"]) for r in bad] == [("corrupt record", "no json")]
