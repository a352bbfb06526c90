"""Properties of the physical plans that matter at scale."""

from __future__ import annotations

import re
from dataclasses import replace
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tallyward.catalog import cohorts
from tallyward.catalog.registry import table
from tallyward.operators.firstlast import earliest_per_key, latest_per_key, ranked_first
from tallyward.operators.intervals import asof_latest, followed_within, latest_preceding, preceded_within
from tallyward.operators.joins import inner_enrich
from tallyward.plans.ascertain import diagnosis_events, index_events
from tallyward.plans.emergency import ed_visits, emergency_from_candidates, inpatient_candidates, latest_dyads
from tallyward.plans import cohort, enrich
from tallyward.plans.history import care_bounds, cohort_visits
from tallyward.sources import staging
from tallyward.sources.staging import stage
from tallyward.params import Window
from test_queries import plan


@pytest.fixture(scope="module")
def study(spark, sf_small):
    return cohorts.study(spark, sf_small)


def test_windows_and_columns_reach_the_scans(study):
    w = study.windows
    events = diagnosis_events(study.tables, study.condition, Window(w.washout.start, w.search.end))
    text = plan(events)
    pushed = re.findall(r"PushedFilters: \[(.*?)\]\n", text)
    schemas = re.findall(r"ReadSchema: struct<(.*?)>\n", text)
    bounded = [
        f for f in pushed
        if "GreaterThanOrEqual(o_orderdate,1950-01-01" in f and "LessThanOrEqual(o_orderdate,2001-01-01" in f
    ]
    assert len(bounded) == 2, "visits and registry entries have a plain time column"
    assert len(schemas) >= 8
    assert not any("l_extendedprice" in s or "o_totalprice" in s for s in schemas)


def test_each_fact_is_scanned_once_for_ascertainment(study):
    w = study.windows
    text = plan(diagnosis_events(study.tables, study.condition, Window(w.washout.start, w.search.end)))
    # visits, stays and registry entries live in orders; two bridges in lineitem
    scanned = re.findall(r"Location: InMemoryFileIndex \[.*/(\w+)\.parquet\]", text)
    assert scanned.count("orders") == 3 and scanned.count("lineitem") == 2


def test_interval_joins_are_hashed_on_key_and_bucket(spark, sf_small):
    events = table(spark, sf_small, "events").select("event_id", "user_id", "ts")
    other = events.withColumnsRenamed({"event_id": "other_id", "ts": "other_ts"})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = plan(preceded_within(events, other, "user_id", "ts", "other_ts", 3))
        exists = plan(followed_within(events, other, "user_id", "ts", "other_ts", 24))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert re.search(r"hashpartitioning\(user_id#\d+L, _bucket#\d+L", pairs)
    assert re.search(r"hashpartitioning\(user_id#\d+L, _end_bucket#\d+L", exists)
    assert "partial_max" in exists and "partial_min" in exists


def test_first_per_key_sorts_nothing_before_the_shuffle(spark, sf_small, tmp_path):
    """Times are aggregated by hash and fetched by a join; sorted tables are ranked without a sort or shuffle."""
    lines = table(spark, sf_small, "lineitem").select("l_suppkey", "l_orderkey", "l_shipdate")
    for pick in (earliest_per_key, latest_per_key):
        text = plan(pick(lines, "l_suppkey", "l_shipdate"))
        assert "HashAggregate" in text and "BroadcastHashJoin" in text and "Sort" not in text and "Window" not in text
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(earliest_per_key(lines, "l_suppkey", "l_shipdate"))
        spark.sql(f"CREATE DATABASE IF NOT EXISTS test_sorted LOCATION '{tmp_path}'")
        lines.write.bucketBy(4, "l_suppkey").sortBy("l_suppkey", "l_shipdate").saveAsTable("test_sorted.lines")
        ranked = ranked_first(spark.table("test_sorted.lines"), "l_suppkey", "l_shipdate")
        assert "Exchange" not in plan(ranked)
        assert sorted(ranked.collect()) == sorted(earliest_per_key(lines, "l_suppkey", "l_shipdate").collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP DATABASE IF EXISTS test_sorted CASCADE")
    below = [part.split("Scan parquet")[0] for part in text.split("Exchange")[1:] if "Scan parquet" in part]
    assert below and all("Sort" not in part for part in below[:2])


def test_a_hot_key_is_split_when_its_first_rows_are_fetched(spark, split_joins):
    """Nine rows in ten have one key, and all of its rows the same time."""
    visits = _hot(spark, [F.col("id"), F.timestamp_add("SECOND", (F.col("id") % 10 - 9).cast("int"), F.lit("2020-01-01").cast("timestamp_ntz")).alias("t")])
    visits = visits.withColumn("t", F.when(F.col("PatientSID") == 7, F.lit("2020-01-01").cast("timestamp_ntz")).otherwise(F.col("t")))
    found = earliest_per_key(visits, "PatientSID", "t")
    assert "skew=true" in _final_plan(found)
    assert found.count() == 200_000


def test_the_latest_event_before_is_merged_without_a_join(spark, study, split_joins):
    """The line is dealt by person and bucket; only rows with the latest event go on."""
    text = plan(latest_dyads(study.index, study.emergency, 30))
    assert "Join" not in text
    assert re.search(r"hashpartitioning\(_key#\d+, _bucket#\d+L", text) and "WindowGroupLimit" in text
    days = F.timestamp_add("DAY", (F.col("id") % 1000).cast("int"), F.lit("2020-01-01").cast("timestamp_ntz"))
    late = spark.range(0, 20_000, 1, 4).select(F.lit(7).alias("k"), F.col("id").alias("a"), days.alias("t"))
    early = late.select("k", F.col("a").alias("b"), F.col("t").alias("u")).filter("b % 500 = 3")
    merged = asof_latest(late, early, "k", "t", "u", 5)
    assert sorted(merged.collect()) == sorted(latest_preceding(late, early, "k", "t", "u", 5).select(*merged.columns).collect())
    assert merged.count() == 20 * 6 * 20


def test_history_is_folded_before_the_shuffle(study):
    text = plan(care_bounds(study.sites, study.tables))
    assert "partial_max" in text and "partial_min" in text


def test_visits_are_cut_by_an_inner_join_and_folded_before_they_are_written(spark, study, split_joins):
    """No outer join reads the fact; a hot site is split; a person is one care row."""
    ids = study.index.select(F.col("DiagnosisEventSID").alias("VisitSID"))
    text = plan(cohort_visits(study.tables, study.sites, ids))
    assert "LeftOuter" not in text and "FullOuter" not in text and "RightOuter" not in text
    assert "partial_max" in text and "partial_min" in text
    care = study.visits.filter("kind = 'care'")
    assert care.count() == care.select("PatientSSN").distinct().count() > 0
    time = F.lit("2020-01-01").cast("timestamp_ntz")
    visits = _hot(spark, [F.col("id").alias("VisitSID"), time.alias("VisitDateTime"),
                          (F.col("id") % 4).alias("PrimaryStopCodeSID"), F.lit(1).alias("Sta3n")])
    sites = spark.range(0, 200_000, 1, 4).select(F.col("id").cast("string").alias("PatientSSN"), F.col("id").alias("PatientSID"))
    tables = SimpleNamespace(outpat_workload=visits, dim_stopcode=study.tables.dim_stopcode)
    ids = spark.range(0, 200_000, 1, 4).select(F.col("id").alias("VisitSID"))
    assert "skew=true" in _final_plan(cohort_visits(tables, sites, ids))


def _hot(spark, columns):
    """Rows of which nine in ten share site 7."""
    n = F.col("id")
    site = F.when(n % 10 < 9, 7).otherwise(n).cast("bigint").alias("PatientSID")
    return spark.range(0, 200_000, 1, 4).select(site, *columns)


@pytest.fixture
def split_joins(spark):
    """Settings under which AQE splits what it may split."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_sites_are_split(spark, split_joins):
    span = Window(F.lit("2000-01-01").cast("timestamp_ntz"), F.lit("2030-01-01").cast("timestamp_ntz"))
    time = F.timestamp_add("SECOND", F.col("id").cast("int"), F.lit("2020-01-01").cast("timestamp_ntz"))
    sites = spark.range(0, 200_000, 1, 4).select(F.col("id").cast("string").alias("PatientSSN"), F.col("id").alias("PatientSID"))
    stays = _hot(spark, [F.col("id").alias("InpatientSID"), time.alias("AdmitDateTime")])
    visits = _hot(spark, [F.col("id").alias("VisitSID"), time.alias("PatientArrivalDateTime"), time.alias("DispositionDateTime")])
    tables = SimpleNamespace(inpat_inpatient=stays, edis_edislog=visits)
    assert "skew=true" in _final_plan(inpatient_candidates(tables, sites, span))
    assert "skew=true" in _final_plan(ed_visits(tables, sites, span))
    people = _hot(spark, [F.col("id").alias("x")])
    assert "skew=true" in _final_plan(inner_enrich(people, "PatientSID", sites))


def test_building_plans_starts_no_jobs(study):
    """Stages aside, a plan is only described: scalar subqueries decide within it."""
    tracker = study.events.sparkSession.sparkContext.statusTracker()
    events, candidates = study.events, study.candidates
    before = len(tracker.getJobIdsForGroup(None))
    index_events(events, study.windows)
    emergency_from_candidates(candidates, study.tables)
    assert len(tracker.getJobIdsForGroup(None)) == before


def test_plans_behind_the_stages(study, monkeypatch):
    """The visits are read twice in all, and no plan joins everything with everything."""
    plans = []

    def recorded(df, name, folder=None):
        plans.append(plan(df))
        return stage(df, name, folder)

    monkeypatch.setattr(staging, "stage", recorded)  # behind the counted stages
    monkeypatch.setattr(cohort, "stage", recorded)
    monkeypatch.setattr(enrich, "stage", recorded)
    visits = stage(study.tables.outpat_workload, "seen-visits")
    marker = visits.inputFiles()[0].rsplit("/", 2)[1]
    fresh = cohort.Study(replace(study.tables, outpat_workload=visits), study.params, study.condition)
    results = [plan(fresh.denominator()), plan(fresh.numerator())]
    for text in plans + results:
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    scans = sum(len(re.findall(rf"Location: InMemoryFileIndex \[.*{marker}", text)) for text in plans + results)
    assert len(plans) >= 8 and scans == 2, "once for the condition's events, once for history and places"
