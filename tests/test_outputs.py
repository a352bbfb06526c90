"""The life cycle of stages and outputs: release, replacement, and what a lost driver leaves."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from compare import spark_rows
from tallyward import StudyParams
from tallyward.plans import cohort
from tallyward.plans.cohort import Study, build_cohorts, write_cohorts
from tallyward.sources import outputs
from tallyward.sources.outputs import read_output, replace_output, replace_table
from tallyward.sources.staging import Stages, counted_stage, finished, stage, stage_root
from warehouse import START, random_warehouse, to_spark


def names(folder):
    return sorted(p.name for p in Path(folder).iterdir() if not p.name.startswith("."))


def files_of(stages):
    return [p for path in stages.paths for p in Path(path.removeprefix("file:")).rglob("*") if p.is_file()]


def test_release_deletes_the_files_of_a_handle_and_no_others(spark):
    outer, inner = Stages(), Stages()
    with outer.open():
        kept = stage(spark.range(3), "kept")
        with inner.open():
            gone = stage(spark.range(4), "gone")
            assert gone.count() == 4
        also_kept = stage(spark.range(5), "kept")
    free = stage(spark.range(6), "free")
    paths = inner.paths
    assert len(outer.paths) == 2 and len(paths) == 1 and files_of(inner)
    inner.release()
    inner.release()
    assert not any(Path(p.removeprefix("file:")).exists() for p in paths) and inner.paths == []
    assert (kept.count(), also_kept.count(), free.count()) == (3, 5, 6)
    outer.release()
    assert free.count() == 6


def test_stages_are_handed_over(spark):
    outer, inner = Stages(), Stages()
    with outer.open():
        with inner.open():
            kept = stage(spark.range(3), "kept")
        inner.hand_over()
    inner.release()
    assert kept.count() == 3 and len(outer.paths) == 1
    outer.release()
    inner.hand_over()


def test_a_finished_stage_outlives_those_it_was_made_from(spark):
    made = []

    def build():
        made.append(stage(spark.range(10), "inner"))
        return made[0].where("id > 6")

    holder = Stages()
    with holder.open():
        result = finished(build, "result")
    assert result.count() == 3 and len(holder.paths) == 1
    with pytest.raises(Exception, match="(?i)not exist|FILE_NOT_EXIST|FAILED_READ"):
        made[0].count()
    with pytest.raises(ZeroDivisionError):
        finished(lambda: made.append(stage(spark.range(1), "failing")) or 1 / 0, "result")
    assert not Path(made[1].inputFiles()[0].removeprefix("file://")).exists() if made[1].inputFiles() else True


def test_a_cohort_is_read_while_it_is_replaced(spark, tmp_path):
    target = str(tmp_path / "cohort")
    with pytest.raises(FileNotFoundError):
        read_output(spark, target)
    replace_output(spark.range(0, 1000, 1, 8), target)
    reading = read_output(spark, target)
    rows = reading.toLocalIterator()
    seen = [next(rows)["id"]]
    replace_output(spark.range(0, 5), target)
    seen += [r["id"] for r in rows]
    assert sorted(seen) == list(range(1000)), "who reads the old version reads all of it"
    assert read_output(spark, target).count() == 5
    assert reading.count() == 1000, "the version before stays"
    replace_output(read_output(spark, target).unionByName(spark.range(7, 8)), target)
    assert read_output(spark, target).count() == 6
    assert sum(n.startswith("version-") for n in names(target)) == 2, "older versions go"


def test_a_lost_driver_leaves_the_old_cohort(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "cohort")
    replace_output(spark.range(3), target)
    with pytest.raises(Exception, match="lost"):
        replace_output(spark.range(9).select(F.raise_error(F.lit("lost")).cast("long").alias("id")), target)
    assert read_output(spark, target).count() == 3

    def lost(*_):
        raise RuntimeError("lost before the rename")

    monkeypatch.setattr(outputs, "_point", lost)
    with pytest.raises(RuntimeError):
        replace_output(spark.range(9), target)
    monkeypatch.undo()
    assert read_output(spark, target).count() == 3
    assert sum(n.startswith("version-") for n in names(target)) >= 2, "what was written is there, but not current"
    replace_output(spark.range(4), target)
    assert read_output(spark, target).count() == 4 and sum(n.startswith("version-") for n in names(target)) == 2


def test_a_table_is_replaced_at_once(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS test_outputs LOCATION '{tmp_path}/db'")
    try:
        folder = str(tmp_path / "rows")
        replace_table(spark.range(3), "test_outputs.cohort", folder)
        old = spark.table("test_outputs.cohort")
        assert old.count() == 3
        replace_table(spark.table("test_outputs.cohort").unionByName(spark.range(8, 10)), "test_outputs.cohort", folder)
        assert spark.table("test_outputs.cohort").count() == 5
        assert read_output(spark, folder).count() == 5
    finally:
        spark.sql("DROP DATABASE test_outputs CASCADE")


def test_cohorts_are_written_and_every_stage_is_released(spark, tmp_path, monkeypatch):
    tables, params = to_spark(spark, random_warehouse(8, False)), StudyParams(search_start=START)
    expected = [spark_rows(df) for df in build_cohorts(tables, params)]
    made = []
    monkeypatch.setattr(cohort, "Study", lambda *a: made.append(Study(*a)) or made[-1])
    root = Path(stage_root(spark).removeprefix("file:"))
    before = {p.name for p in root.iterdir()}
    targets = [str(tmp_path / "denominator"), str(tmp_path / "numerator")]
    write_cohorts(tables, *targets, params)
    assert [spark_rows(read_output(spark, t)) for t in targets] == expected
    assert len(made) == 1 and made[0].stages.paths == []
    assert {p.name for p in root.iterdir()} <= before, "no files after release"


def test_counts_are_taken_while_a_stage_is_written(spark):
    rows = [("a", 1), ("a", 1), ("b", None), (None, 2), (None, 2), (None, None), ("c", 3)] + [("hot", i) for i in range(500)]
    df = spark.createDataFrame(rows, "person string, site int").repartition(5)
    jobs = spark.sparkContext.statusTracker()
    staged, counts = counted_stage(df, "counted", "person", ["site"], persons=True)
    before = len(jobs.getJobIdsForGroup(None))
    assert counts == {"rows": 507, "null_person": 3, "null_site": 2, "persons": 4}
    assert len(jobs.getJobIdsForGroup(None)) == before, "no scan of its own"
    assert spark_rows(staged) == spark_rows(df)
    staged, counts = counted_stage(df, "counted", "person")
    assert counts == {"rows": 507, "null_person": 3} and staged.columns == df.columns
    _, counts = counted_stage(df.limit(0), "counted", "person", persons=True)
    assert counts == {"rows": 0, "null_person": 0, "persons": 0}
