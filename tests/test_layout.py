"""Facts by year: the same rows, and folders pruned before files are opened."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import functions as F

from compare import spark_rows
from tallyward import COLORECTAL, StudyParams, windows
from tallyward.params import Window
from tallyward.plans import ascertain, emergency
from tallyward.plans.cohort import Study
from tallyward.sources.layout import YEAR, in_window, in_years, lay_out, laid_out, read_by_year, write_by_year
from test_queries import plan
from warehouse import START, random_warehouse, to_spark


def files_read(df):
    return {re.search(rf"{YEAR}=(\w+)", f)[1] for f in df.inputFiles()}


def test_windows_prune_years(spark, tmp_path):
    times = [datetime(y, m, 15) for y in range(1990, 2003) for m in (1, 12)] + [None, datetime(2000, 12, 31, 23, 59, 59), datetime(2001, 1, 1)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "id int, t timestamp_ntz")
    target = str(tmp_path / "facts")
    write_by_year(df, target, "t")
    laid = read_by_year(spark, target, df)
    assert laid.columns == ["id", "t", YEAR] and spark_rows(laid.drop(YEAR)) == spark_rows(df)
    window = windows(StudyParams(search_start=datetime(2000, 1, 1))).emergency
    found = in_window(laid, "t", window)
    assert spark_rows(found.drop(YEAR)) == spark_rows(in_window(df, "t", window))
    text = plan(found)
    assert re.search(rf"PartitionFilters: \[.*{YEAR}#\d+ >= 1999.*{YEAR}#\d+ <= 2001", text)
    assert "PushedFilters: [IsNotNull(t), GreaterThanOrEqual(t," in text
    write_by_year(df.limit(0), str(tmp_path / "none"), "t")
    assert in_window(read_by_year(spark, str(tmp_path / "none"), df), "t", window).count() == 0


def test_years_known_at_run_time_prune_folders(spark, tmp_path):
    df = spark.range(0, 5000).select("id", F.timestamp_add("DAY", F.col("id").cast("int"), F.lit("1990-01-01").cast("timestamp_ntz")).alias("t"))
    write_by_year(df, str(tmp_path), "t")
    laid = read_by_year(spark, str(tmp_path), df)
    studies = spark.createDataFrame([(1994, "a"), (1994, "b"), (1999, "c"), (None, "a")], f"{YEAR} int, name string")
    studies.write.parquet(str(tmp_path) + "-studies")
    wanted = spark.read.parquet(str(tmp_path) + "-studies").filter("name <> 'c'")
    found = in_years(laid, wanted)
    assert "dynamicpruning" in plan(found).lower()
    assert spark_rows(found.drop(YEAR)) == spark_rows(df.filter(F.year("t") == 1994))


def test_a_study_over_laid_out_facts_is_the_same(spark, tmp_path):
    tables = to_spark(spark, random_warehouse(4, False))
    laid = lay_out(tables, str(tmp_path))
    again = laid_out(spark, str(tmp_path), tables)
    params = StudyParams(search_start=START)
    plain, by_year = Study(tables, params, COLORECTAL), Study(laid, params, COLORECTAL)
    for output in ("denominator", "numerator"):
        assert spark_rows(getattr(by_year, output)()) == spark_rows(getattr(plain, output)())
    assert spark_rows(Study(again, params, COLORECTAL).index) == spark_rows(plain.index)
    w = plain.windows
    for df in (ascertain.diagnosis_events(laid, COLORECTAL, w.search),
               emergency.inpatient_candidates(laid, plain.sites, w.emergency), emergency.ed_visits(laid, plain.sites, w.emergency)):
        filters = re.findall(r"PartitionFilters: \[(.*?)\]\n", plan(df))
        assert sum(YEAR in f for f in filters) >= 1
    span = Window(w.search.start, w.search.end)
    assert files_read(in_window(laid.inpat_inpatient, "AdmitDateTime", span)) >= {"2000"}
