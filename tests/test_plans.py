import datetime as dt

import pytest

from larder.plans import change_job, current_job, quality_job, recipe_job
from larder.quality import QualityGateError
from larder.schemas import RECIPE_AGGREGATE, VALIDATION_REPORT
from larder.sources import read_files
from tests.cookbook import AVERAGES, row, rows, write_json


def result(spark, path):
    return {r[0]: r[1] for r in read_files(spark, "csv", path, RECIPE_AGGREGATE).collect()}


def test_recipe_job(spark, tmp_path):
    folder, out = write_json(tmp_path / "in", rows()), tmp_path / "out"
    recipe_job.run(spark, folder, str(out))
    assert result(spark, str(out)) == AVERAGES
    files = list(out.glob("*.csv"))
    assert len(files) == 1
    assert files[0].read_text().startswith("difficulty,avg_total_cooking_time\n")


def test_recipe_job_by_command_line(spark, tmp_path):
    folder, out = write_json(tmp_path / "in", rows()), str(tmp_path / "out")
    recipe_job.main(["--input", folder, "--output", out, "--keyword", "FLOUR"])
    assert result(spark, out) == {"hard": 180.0}


def test_bad_rows_go_to_quarantine(spark, tmp_path):
    records = [
        *rows(),
        row("Odd", "beef", "soon", "PT5M"),
        row("Late", "beef", "PT5M", None),
        row("Leek", "leek", "soon", "PT5M"),
        "no json",
    ]
    folder, out, bad = write_json(tmp_path / "in", records), tmp_path / "out", tmp_path / "bad"
    recipe_job.run(spark, folder, str(out), quarantine_path=str(bad))
    assert result(spark, str(out)) == AVERAGES
    got = spark.read.parquet(str(bad)).collect()
    reasons = {r["name"]: r["reason"] for r in got}
    assert reasons == {
        "Odd": "malformed cookTime",
        "Late": "missing prepTime",
        None: "corrupt record",
    }
    assert [r["_corrupt_record"] for r in got if r["name"] is None] == ["no json"]


def test_results_by_execution_day_are_kept(spark, tmp_path):
    write_json(tmp_path / "in" / "2019" / "11" / "28", rows()[:1])
    write_json(tmp_path / "in" / "2019" / "11" / "29", rows()[1:])
    for day in (28, 29):
        recipe_job.run(
            spark,
            str(tmp_path / "in"),
            str(tmp_path / "out"),
            execution_day=dt.date(2019, 11, day),
        )
    assert result(spark, str(tmp_path / "out" / "execution_date=2019-11-28")) == {"hard": 140.0}
    later = result(spark, str(tmp_path / "out" / "execution_date=2019-11-29"))
    assert later == {**AVERAGES, "hard": 61.0}


def test_gate_stops_before_the_load(spark, tmp_path):
    folder, out = write_json(tmp_path / "in", rows()), tmp_path / "out"
    with pytest.raises(QualityGateError) as error:
        recipe_job.run(spark, folder, str(out), gate=True)
    assert error.value.stage == "input"
    assert not out.exists()


def test_gate_stops_on_nothing_and_keeps_the_previous_output(spark, tmp_path):
    good = [r for r in rows() if r["ingredients"]]
    folder, out = write_json(tmp_path / "in", good), str(tmp_path / "out")
    recipe_job.run(spark, folder, out, gate=True)
    with pytest.raises(QualityGateError) as error:
        recipe_job.run(spark, folder, out, keyword="no such thing", gate=True)
    assert error.value.stage == "output"
    assert result(spark, out) == AVERAGES


def test_layer_keeps_days_and_replaces_a_day_loaded_again(spark, tmp_path):
    root, layer = tmp_path / "in", str(tmp_path / "layer")
    write_json(root / "2019" / "11" / "28", [rows()[0]])
    second = write_json(root / "2019" / "11" / "29", [{**rows()[1], "cookTime": "soon"}])
    load = ["--step", "preprocess", "--input", str(root), "--output", layer, "--execution-day"]
    for day in ("2019-11-28", "2019-11-29"):
        recipe_job.main([*load, day])
    assert spark.read.parquet(layer).where("status = 'quarantined'").count() == 1
    write_json(root / "2019" / "11" / "29", [rows()[1]])
    recipe_job.main([*load, "2019-11-29"])
    got = spark.read.parquet(layer).select("url", "status").collect()
    assert sorted(r["url"] for r in got) == sorted(r["url"] for r in rows()[:2])
    assert {r["status"] for r in got} == {"ok"}
    assert second


@pytest.mark.parametrize(
    "options", [["--step", "preprocess", "--gate"], ["--step", "result", "--quarantine", "q"]]
)
def test_options_that_a_step_cannot_honour_are_refused(options):
    with pytest.raises(SystemExit):
        recipe_job.main(["--input", "in", "--output", "out", *options])


def test_gate_lets_good_data_pass(spark, tmp_path):
    good = [r for r in rows() if r["ingredients"]]
    folder, out = write_json(tmp_path / "in", good), str(tmp_path / "out")
    recipe_job.run(spark, folder, out, gate=True)
    assert result(spark, out) == AVERAGES


def test_result_from_the_parquet_layer(spark, tmp_path):
    records = [*rows(), row("Odd", "beef", "soon", "PT5M"), "no json"]
    folder = write_json(tmp_path / "in", records)
    landed, out = str(tmp_path / "landed"), str(tmp_path / "out")
    recipe_job.preprocess(spark, folder, landed)
    recipe_job.run_on_preprocessed(spark, landed, out)
    assert result(spark, out) == AVERAGES


def test_two_steps_by_command_line(spark, tmp_path):
    records = [r for r in rows() if r["ingredients"]] + [row("Odd", "beef", "soon", "PT5M")]
    folder = write_json(tmp_path / "in", records)
    landed, out = str(tmp_path / "landed"), str(tmp_path / "out")
    recipe_job.main(["--step", "preprocess", "--input", folder, "--output", landed])
    recipe_job.main(["--step", "result", "--input", landed, "--output", out, "--gate"])
    assert result(spark, out) == AVERAGES


@pytest.mark.parametrize("persist", [False, True])
def test_quality_job(spark, tmp_path, persist):
    folder, out = write_json(tmp_path / "in", rows()), tmp_path / "out"
    assert quality_job.run(spark, "files|recipe", folder, str(out), persist=persist)
    report = read_files(spark, "csv", str(out), VALIDATION_REPORT).collect()
    assert [r["Test_Case_Id"] for r in report] == [f"RECIPE_TC_{i}" for i in range(9)]
    assert [i for i, r in enumerate(report) if r["Test_Result"] == "Failure"] == [3]
    assert len(list(out.glob("*.csv"))) == 1


def test_quality_job_on_the_written_result(spark, tmp_path):
    folder, out = write_json(tmp_path / "in", rows()), str(tmp_path / "out")
    recipe_job.run(spark, folder, out)
    report = str(tmp_path / "report")
    quality_job.main(
        ["--dataset", "recipe_aggregate", "--input", out, "--report", report, "--format", "csv"]
    )
    rows_ = read_files(spark, "csv", report, VALIDATION_REPORT).collect()
    assert [r["Test_Result"] for r in rows_] == ["Success"] * 5
    assert rows_[2]["Test_Case"] == (
        "ComplianceConstraint(Compliance(difficulty contained in easy,medium,hard,"
        "`difficulty` IS NULL OR `difficulty` IN ('easy','medium','hard'),None))"
    )


def test_no_report_on_empty_input(spark, tmp_path):
    (tmp_path / "in").mkdir()
    out = tmp_path / "out"
    assert not quality_job.run(spark, "recipe", str(tmp_path / "in"), str(out))
    assert not out.exists()


def test_unknown_dataset(spark, tmp_path):
    with pytest.raises(KeyError):
        quality_job.run(spark, "drinks", str(tmp_path), str(tmp_path / "out"))


def test_change_job(spark, tmp_path):
    old = rows()
    new = [dict(r) for r in old[1:]]
    new[0]["cookTime"] = "PT50M"
    new[1]["description"] = "not tracked"
    new.append(row("Roast", "beef", "PT3H", "PT0M"))
    before, after = write_json(tmp_path / "old", old), write_json(tmp_path / "new", new)
    out = str(tmp_path / "out")
    change_job.main(["--before", before, "--after", after, "--output", out])
    got = {
        r["change"]: (r["old_name"], r["new_name"], r["old_difficulty"], r["new_difficulty"])
        for r in spark.read.parquet(out).collect()
    }
    assert got == {
        "removed": ("Stew", None, "hard", None),
        "changed": ("Tacos", "Tacos", "easy", "hard"),
        "added": (None, "Roast", None, "hard"),
    }


def test_changes_show_duplicates_and_lines_without_key(spark, tmp_path):
    old = [row("Stew", "beef", "PT1H", "PT1M"), row("Soup", "beef", "PT1H", "PT1M")]
    newer = {**old[0], "datePublished": "2020-01-01", "name": "Aa"}
    older = {**old[0], "datePublished": "2012-01-01", "name": "Zz"}
    before = write_json(tmp_path / "before", [*old, "no json"])
    after = write_json(tmp_path / "after", [older, newer, old[1], {**old[1], "url": None}])
    out, often, bad = (str(tmp_path / name) for name in ("out", "often", "bad"))
    change_job.main(
        ["--before", before, "--after", after, "--output", out, "--duplicates", often,
         "--quarantine", bad]
    )
    changes = spark.read.parquet(out).collect()
    assert [(r["url"], r["change"], r["new_name"]) for r in changes] == [
        (old[0]["url"], "changed", "Aa")
    ]
    assert [tuple(r) for r in spark.read.parquet(often).collect()] == [(old[0]["url"], 1, 2)]
    assert {(r["snapshot"], r["reason"]) for r in spark.read.parquet(bad).collect()} == {
        ("before", "corrupt record"),
        ("after", "missing url"),
    }


def test_current_state_counts_each_recipe_once(spark, tmp_path):
    first, last = dt.date(2019, 11, 28), dt.date(2019, 11, 30)
    stew, soup = row("Stew", "beef", "PT1H", "PT40M"), row("Soup", "beef", "PT5M", "PT5M")
    loads = {
        first: [stew, soup],
        dt.date(2019, 11, 29): [{**stew, "cookTime": "PT20M"}, {**soup, "cookTime": "soon"}],
        last: [row("Roast", "beef", "PT2H", "PT0M")],
    }
    layer, current = str(tmp_path / "layer"), str(tmp_path / "current")
    for day, records in loads.items():
        raw = write_json(tmp_path / "in" / f"{day:%Y/%m/%d}", records)
        recipe_job.preprocess(spark, str(tmp_path / "in"), layer, day)
        assert raw
        for _ in range(2):  # a repeated run changes nothing
            current_job.main(["--layer", layer, "--current", current, "--day", str(day)])

    def average(day):
        return {r[0]: r[1] for r in current_job.current_average(spark, current, day).collect()}

    assert average(first) == {"hard": 100.0, "easy": 10.0}
    assert average(last) == {"hard": 120.0, "medium": 60.0, "easy": 10.0}
    state = current_job.read_current(spark, current, last)
    assert state.count() == state.select("url").distinct().count() == 3
