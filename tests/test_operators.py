"""Operators on small frames with the edge rows that decide their semantics."""

from __future__ import annotations

import random
from types import SimpleNamespace
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward import StudyParams, schemas, windows
from tallyward.functions import dates, labels, predicates as P, text
from tallyward.operators import aggregates, firstlast, intervals, joins, setops
from tallyward.params import params_df
from tallyward.plans import ascertain, emergency, history, measures
from tallyward.plans.conditions import COLORECTAL, LUNG, PROSTATE
from tallyward.sources.outputs import write_output
from tallyward.sources.staging import conform, stage, stage_root
from tallyward.sources.tables import COLUMNS, SourceTables, code_set
from warehouse import random_warehouse, to_spark


def values(df, *cols):
    return sorted((tuple(r[c] for c in cols) if len(cols) > 1 else r[cols[0]] for r in df.collect()), key=repr)


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def ntz(value):
    return F.lit(value).cast("timestamp_ntz")


# --- columns ---------------------------------------------------------------

def test_concat_counts_null_as_empty(spark):
    assert one(spark, text.concat_null_empty(F.lit(None), F.lit(" OF THE "), F.lit("COLON"))) == " OF THE COLON"
    assert one(spark, text.location_label(F.lit("Boston"), F.lit("MA"))) == "'Boston, 'MA"
    assert one(spark, text.location_label(F.lit(None), F.lit(None))) == "', '"
    assert one(spark, text.quote_wrap(F.lit(7))) == "'7'"
    assert one(spark, text.report_line("n", F.lit(None).cast("int"))) is None
    assert one(spark, text.strip_dots(F.lit("Z51.1.1"))) == "Z5111"


@pytest.mark.parametrize("unit, a, b, expected", [
    ("MONTH", "2000-01-31 23:00:00", "2000-02-01 00:00:00", 1),
    ("MONTH", "2000-02-01 00:00:00", "2000-02-29 23:00:00", 0),
    ("MONTH", "2001-03-01 00:00:00", "2000-12-31 00:00:00", -3),
    ("YEAR", "1950-12-31 00:00:00", "2000-01-01 00:00:00", 50),
    ("YEAR", "2000-01-01 00:00:00", "2000-12-31 00:00:00", 0),
])
def test_boundary_differences(spark, unit, a, b, expected):
    assert one(spark, dates.datediff_boundary(unit, ntz(a), ntz(b))) == expected


def test_unknown_unit_is_refused(spark):
    with pytest.raises(ValueError):
        dates.datediff_boundary("DAY", ntz("2000-01-01"), ntz("2000-01-02"))


@pytest.mark.parametrize("unit, n, start, expected", [
    ("MONTH", 1, "2000-01-31 10:00:00", datetime(2000, 2, 29, 10)),
    ("YEAR", -50, "2000-02-29 10:00:00", datetime(1950, 2, 28, 10)),
    ("DAY", -30, "2000-01-15 13:30:00", datetime(1999, 12, 16, 13, 30)),
    ("HOUR", 24, "2000-02-28 13:30:00", datetime(2000, 2, 29, 13, 30)),
])
def test_dateadd_keeps_time_of_day(spark, unit, n, start, expected):
    assert one(spark, dates.dateadd(unit, n, ntz(start))) == expected


def test_time_bucket_ignores_session_zone(spark):
    times = [datetime(2000, 4, 2, 1, 59, 59), datetime(2000, 4, 2, 3), datetime(1969, 12, 31, 23), datetime(2000, 10, 29, 1)]
    expected = [(t - datetime(1970, 1, 1)) // timedelta(hours=6) for t in times]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert [r[0] for r in df.select(dates.time_bucket(F.col("t"), 6 * 3600)).collect()] == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_predicates_on_null_and_case(spark):
    df = spark.createDataFrame([("i",), ("I ",), ("II",), ("0",), (None,)], "s string")
    assert values(df.filter(P.in_bucket("s", ["I"])), "s") == ["I ", "i"]
    assert values(df.filter(P.other_or_null("s", ["I", "II"])), "s") == ["0", None]
    assert values(df.filter(P.none_like("s", ["I%"])), "s") == ["0", "i"]
    assert values(df.filter(P.not_any_like("s", ["I%", "%i"])), "s") == ["0"]
    keys = spark.createDataFrame([(-1,), (3,), (None,)], "k int")
    assert values(keys.filter(P.not_sentinel("k")), "k") == [3]
    assert values(keys.filter(P.not_in_default("k", [3, 4])), "k") == [-1, None]
    assert values(keys.filter(P.not_in_default("k", [0])), "k") == [-1, 3]


def test_condition_patterns(spark):
    codes = spark.createDataFrame([("XC18Y", "0153"), ("c20", "1530"), ("K1", "154.2"), (None, None)], "a string, b string")
    assert values(codes.filter(COLORECTAL.icd10("a")), "a") == ["XC18Y", "c20"]
    assert values(codes.filter(COLORECTAL.icd9("b")), "b") == ["1530"]
    sites = spark.createDataFrame([("lung, NOS", None, None), (None, "Prostate", None), (None, None, "x")],
                                  "SitegpX string, ICDOSite string, PrimarysiteX string")
    assert sites.filter(LUNG.site()).count() == 1 and sites.filter(PROSTATE.site()).count() == 1


def test_race_ladder_and_flags(spark):
    df = spark.createDataFrame([
        ("HISPANIC OR LATINO", "WHITE"), ("no", "white "), (None, "BLACK OR AFRICAN AMERICAN"), ("no", None), (None, "X"),
    ], "e string, r string")
    assert [r[0] for r in df.select(labels.race_ladder("e", "r")).collect()] == ["HISPANIC", "WHITE", "BLACK", "OTHER", "OTHER"]
    deltas = spark.createDataFrame([(23,), (24,), (25,), (None,), (-5,)], "d int")
    assert [tuple(r) for r in deltas.select(labels.flag_threshold("d", ">", 24), labels.flag_threshold("d", "<", 24)).collect()] == [
        (0, 1), (0, 0), (1, 0), (0, 0), (0, 1)]


# --- joins -----------------------------------------------------------------

@pytest.mark.parametrize("listed, expected", [
    ([2], [1, 3]), ([2, None], []), ([None], []), ([], [1, 2, 3, None]),
])
def test_not_in_follows_three_valued_logic(spark, listed, expected):
    probe = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    other = spark.createDataFrame([(k,) for k in listed], "k int")
    assert values(joins.not_in(probe, other, "k"), "k") == expected
    if None not in listed:
        assert values(joins.not_in(probe, other, "k", null_list=False), "k") == expected
        known = probe.filter("k IS NOT NULL")
        assert values(joins.not_in(known, other, "k", null_probes=False, null_list=False), "k") == [k for k in expected if k]


def test_lookup_event_keeps_unmatched_and_fans_out(spark):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    events = spark.createDataFrame([(1, 10), (1, 11), (1, 11), (9, 12)], "id int, station int")
    assert values(joins.lookup_event(df, events, "id", ["station"]), "id", "station") == [(1, 10), (1, 11), (2, None)]


def test_second_role_key(spark):
    df = spark.createDataFrame([(1, 1, 2)], "v int, a int, b int")
    dim = spark.createDataFrame([(1, 323), (2, 107)], "sid int, stop int")
    assert values(joins.role_dim(df, dim, "a", "sid", "stop"), "stop1", "stop2") == [(323, 323)]
    assert values(joins.role_dim(df, dim, "a", "sid", "stop", "b"), "stop1", "stop2") == [(323, 107)]


def test_secondary_stop_code_can_exclude_when_asked_for(spark):
    rows = random_warehouse(3, False)
    rows["outpat_workload"] = [(1, 5, datetime(2000, 1, 1), 1, 10), (2, 5, datetime(2000, 1, 1), 3, 10)]
    tables = to_spark(spark, rows)
    second = tables.outpat_workload.withColumn("SecondarySID", F.lit(3).cast("bigint"))
    tables = SourceTables(**{**vars(tables), "outpat_workload": second})
    assert values(history.primary_care_visits(tables), "VisitSID") == [1]
    assert values(history.primary_care_visits(tables, "SecondarySID"), "VisitSID") == []


def test_rejoin_drops_rows_without_flags(spark):
    base = spark.createDataFrame([(1, 1), (1, 2)], "p int, e int")
    flags = spark.createDataFrame([(1, 1, 0), (1, 1, 0)], "p int, e int, f int")
    assert values(joins.rejoin(base, flags, ["p", "e"]), "p", "e", "f") == [(1, 1, 0)]


# --- intervals -------------------------------------------------------------

def _timeline(seed, n, keys=3):
    rng = random.Random(seed)
    base = datetime(2000, 1, 1)
    return [
        (i, rng.choice([*range(keys), None]),
         None if rng.random() < 0.05 else base + timedelta(hours=rng.randint(0, 400), seconds=rng.choice([0, 0, 1])))
        for i in range(n)
    ]


@pytest.mark.parametrize("seed, hours", [(1, 24), (2, 5), (3, 48)])
def test_followed_within_equals_brute_force(spark, seed, hours):
    a, b = _timeline(seed, 80), _timeline(seed + 100, 60)
    left = spark.createDataFrame(a, "id int, k int, t timestamp_ntz")
    right = spark.createDataFrame(b, "other int, k int, u timestamp_ntz").drop("other")
    expected = sorted((
        i for i, k, t in a
        if any(k is not None and k == k2 and t and u and t <= u <= t + timedelta(hours=hours) for _, k2, u in b)
    ), key=repr)
    assert values(intervals.followed_within(left, right, "k", "t", "u", hours), "id") == expected
    assert expected


@pytest.mark.parametrize("seed, days", [(4, 1), (5, 3)])
def test_preceded_within_equals_brute_force(spark, seed, days):
    a, b = _timeline(seed, 60), _timeline(seed + 100, 60)
    left = spark.createDataFrame(a, "id int, k int, t timestamp_ntz")
    right = spark.createDataFrame(b, "other int, k int, u timestamp_ntz")
    pairs = [
        (i, o, k, u) for i, k, t in a for o, k2, u in b
        if k is not None and k == k2 and t and u and t - timedelta(days=days) <= u <= t
    ]
    found = intervals.preceded_within(left, right, "k", "t", "u", days)
    assert values(found, "id", "other") == sorted(((i, o) for i, o, _, _ in pairs), key=repr)
    last = {k: max(u for _, _, k2, u in pairs if k2 == k) for _, _, k, _ in pairs}
    for latest in (intervals.latest_preceding, intervals.asof_latest):
        assert values(latest(left, right, "k", "t", "u", days), "id", "other") == sorted(
            ((i, o) for i, o, k, u in pairs if u == last[k]), key=repr)
    twice = intervals.asof_latest(left.unionByName(left), right.unionByName(right), "k", "t", "u", days)
    assert twice.columns == ["id", "k", "t", "other", "u"]
    assert twice.count() == 4 * sum(u == last[k] for _, _, k, u in pairs), "repeated rows on either side count"


def test_lookback_bounds_are_closed_and_keep_time_of_day(spark):
    dx = spark.createDataFrame([(1, datetime(2000, 3, 31))], "k int, t timestamp_ntz")
    times = [datetime(2000, 3, 1), datetime(2000, 2, 29, 23, 59, 59), datetime(2000, 3, 31), datetime(2000, 3, 31, 8)]
    ec = spark.createDataFrame([(1, t) for t in times], "k int, u timestamp_ntz")
    assert values(intervals.preceded_within(dx, ec, "k", "t", "u", 30), "u") == sorted([times[0], times[2]], key=repr)


# --- first and last --------------------------------------------------------

def test_first_and_last_keep_ties_and_treat_null_as_first(spark):
    t1, t2 = datetime(2000, 1, 1), datetime(2000, 1, 2)
    df = spark.createDataFrame([
        (1, "a", t1), (2, "a", t1), (3, "a", t2), (4, "b", None), (5, "b", t2), (6, None, t1), (7, "c", None),
    ], "id int, k string, t timestamp_ntz")
    assert values(firstlast.earliest_per_key(df, "k", "t"), "id") == [1, 2]
    assert values(firstlast.latest_per_key(df, "k", "t"), "id") == [3, 5]
    assert values(firstlast.ranked_first(df, "k", "t"), "id") == [1, 2]
    assert values(firstlast.ranked_first(df, "k", "t", last=True), "id") == [3, 5]
    assert firstlast.earliest_per_key(df, "k", "t").columns == df.columns


def test_first_and_last_equal_brute_force(spark):
    rng = random.Random(11)
    base = datetime(2000, 1, 1)
    rows = [(i, rng.choice([1, 1, 1, 1, 2, 3, 4, None]), None if rng.random() < 0.02 else base + timedelta(days=rng.randint(0, 20)))
            for i in range(300)]
    rows += rows[:5]
    df = spark.createDataFrame(rows, "id int, k int, t timestamp_ntz").repartition(4)
    by_key = {k: [t for _, k2, t in rows if k2 == k] for _, k, _ in rows if k is not None}
    first = {k: None if None in times else min(times) for k, times in by_key.items()}
    last = {k: max((t for t in times if t), default=None) for k, times in by_key.items()}
    for pick, want in ((firstlast.earliest_per_key, first), (firstlast.latest_per_key, last)):
        assert values(pick(df, "k", "t"), "id") == sorted((i for i, k, t in rows if k and t and t == want[k]), key=repr)


# --- sets and counts -------------------------------------------------------

def test_prefer_source(spark):
    df = spark.createDataFrame([("a", "R"), ("a", "C"), ("b", "C"), ("b", "C"), (None, "C")], "p string, s string")
    assert values(setops.prefer_source(df, "p", "s", "R"), "p", "s") == [("a", "R"), ("b", "C")]
    unknown = df.unionByName(spark.createDataFrame([(None, "R")], "p string, s string"))
    assert values(setops.prefer_source(unknown, "p", "s", "R"), "p", "s") == [("a", "R"), (None, "R")]


def test_strata_count_empty_input_and_double_counted_persons(spark):
    df = spark.createDataFrame([("a", "I"), ("a", "II"), ("a", "I"), ("b", "i "), (None, "I"), ("c", None)], "p string, s string")
    counts = aggregates.strata_distinct(df, "p", measures.stage_strata("s"))
    early = aggregates.add_sums(counts, {"early": ["stage_i", "stage_ii"]}).first()
    assert (early["stage_i"], early["stage_ii"], early["stage_other"], early["early"]) == (2, 1, 1, 3)
    assert tuple(aggregates.strata_distinct(df.limit(0), "p", measures.stage_strata("s")).first()) == (0,) * 5


def test_group_count_orders_and_folds_case(spark):
    df = spark.createDataFrame([("I",), ("i ",), ("I",), (None,), ("II",)], "s string")
    assert [tuple(r) for r in aggregates.group_count_desc(df, "s", fold_case=True).collect()] == [(3, "I"), (1, "II"), (1, None)]
    assert [tuple(r) for r in aggregates.group_count_desc(df, "s").collect()] == [(2, "I"), (1, "II"), (1, "i "), (1, None)]


def test_registry_distribution_laws(spark):
    rows = [("LUNG", None, "x", h, s) for h in ("adeno", "SMALL cell", None, "Neuroendocrine")
            for s in ("I", "II", "III", "IV", "0", "NA", None)]
    registry = spark.createDataFrame(rows, "SitegpX string, ICDOSite string, PrimarysiteX string, Histologyicdo3X string, StageGroupingajcc string")
    subset = measures.registry_subset(registry, LUNG, measures.LUNG_EXCLUSIONS)
    by_stage = {r["StageGroupingajcc"]: r["n"] for r in measures.stage_distribution(subset).collect()}
    early = measures.stage_bucket_count(subset, measures.LEGACY_EARLY).first()["n"]
    late = measures.stage_bucket_count(subset, measures.LATE).first()["n"]
    assert early == by_stage["I"] + by_stage["II"] + by_stage["0"]
    assert late == by_stage["III"] + by_stage["IV"]
    assert sum(by_stage.values()) == 7


# --- steps of the pipeline -------------------------------------------------

def _events(spark, rows):
    plain = {"bigint": "long", "timestamp_ntz": "timestamp_ntz"}
    schema = ", ".join(f"{f.name} {plain.get(f.dataType.simpleString(), 'string')}" for f in schemas.CASES)
    return spark.createDataFrame(rows, schema)


def _stepwise_index(events, w):
    cases = events.filter(P.between_closed("DiagnosisEventDateTime", *w.search))
    prior = joins.semi(events.filter(P.between_closed("DiagnosisEventDateTime", *w.washout)), cases, "PatientSID")
    incident = ascertain.washout(cases, prior)
    return ascertain.index_event(setops.prefer_source(incident, "PatientSSN", "TypeOfEvent", ascertain.REGISTRY))


def _case(person, site, day, kind):
    return (person, site, 1, datetime(2000, 1, 1) + timedelta(days=day), "c", "s", kind)


@pytest.mark.parametrize("rows, expected", [
    # a registry case without person voids the coded cases when nobody is washed out
    ([_case(None, 1, 5, ascertain.REGISTRY), _case("a", 2, 6, ascertain.OUTPATIENT), _case("b", 3, 7, ascertain.REGISTRY)], ["b"]),
    # with somebody washed out, the unknown person is dropped first
    ([_case(None, 1, 5, ascertain.REGISTRY), _case("a", 2, 6, ascertain.OUTPATIENT), _case("c", 4, 9, ascertain.INPATIENT),
      _case("c", 4, -9, ascertain.INPATIENT)], ["a"]),
    # an event at the very start is its own prior history; one at the very end counts
    ([_case("a", 1, 0, ascertain.OUTPATIENT), _case("b", 2, 366, ascertain.OUTPATIENT), _case("c", 3, 367, ascertain.OUTPATIENT)], ["b"]),
    # prior history at a site not seen in the search window does not count
    ([_case("a", 1, 3, ascertain.OUTPATIENT), _case("a", 2, -3, ascertain.OUTPATIENT)], ["a"]),
    # registry beats an earlier coded event; ties stay
    ([_case("a", 1, 3, ascertain.OUTPATIENT), _case("a", 1, 8, ascertain.REGISTRY), _case("a", 2, 8, ascertain.REGISTRY)], ["a", "a"]),
])
def test_index_events_edges(spark, rows, expected):
    events = stage(_events(spark, rows), "test")
    w = windows(StudyParams(search_start=datetime(2000, 1, 1)))
    fused = ascertain.index_events(events, w)
    assert values(fused, "PatientSSN") == expected
    assert sorted(fused.collect()) == sorted(_stepwise_index(events, w).select(*fused.columns).collect())


def test_care_flags_combine_when_an_event_id_has_two_times(spark):
    cohort = spark.createDataFrame([("a", 1, datetime(2000, 1, 1)), ("a", 1, datetime(2002, 6, 1))],
                                   "PatientSSN string, DiagnosisEventSID long, DiagnosisEventDateTime timestamp_ntz")
    bounds = spark.createDataFrame([("a", datetime(1999, 1, 1), datetime(1999, 6, 1))],
                                   "PatientSSN string, first_visit timestamp_ntz, last_visit timestamp_ntz")
    flagged = history.care_flags(cohort, bounds, 24)
    expected = sorted((t, b, a) for t in (datetime(2000, 1, 1), datetime(2002, 6, 1)) for b in (0, 1) for a in (0, 1))
    assert sorted(tuple(r) for r in flagged.select("DiagnosisEventDateTime", "HasPCPBeforeCutOff", "HasPCPAfterCutOff").collect()) == expected


def test_unplanned_stay_without_id_is_kept_only_if_nothing_is_planned(spark):
    rows = random_warehouse(3, False)
    t = to_spark(spark, rows)
    stay = lambda key: ("a", 1, key, datetime(2000, 1, 5), emergency.STAY, None)
    schema = "PatientSSN string, PatientSID long, ECEventSID long, ECEventDateTime timestamp_ntz, TypeOfEvent string, ECEventEndDateTime timestamp_ntz"
    planned_id = next(i for i, code, _ in rows["inpat_inpatient_diagnosis"] if code == 5)
    without = emergency.emergency_from_candidates(spark.createDataFrame([stay(None), stay(-77)], schema), t)
    assert values(without, "ECEventSID") == [-77, None]
    with_planned = emergency.emergency_from_candidates(spark.createDataFrame([stay(None), stay(planned_id), stay(-77)], schema), t)
    assert values(with_planned, "ECEventSID") == [-77]


# --- sources, stages, parameters ------------------------------------------

def test_windows_and_params(spark):
    w = windows(StudyParams())
    row = spark.range(1).select(*(b.alias(f"{n}{i}") for n, win in w._asdict().items() for i, b in enumerate(win))).first()
    assert tuple(row) == (datetime(2019, 1, 1), datetime(2020, 1, 1), datetime(1969, 1, 1), datetime(2019, 1, 1),
                          datetime(2018, 12, 2), datetime(2020, 1, 1))
    df = params_df(spark, StudyParams())
    assert df.schema.simpleString() == schemas.STUDY_PARAMS.simpleString()
    assert tuple(df.first()) == (datetime(2019, 1, 1), 12, -50, -30, 24)


def test_conform_binds_by_position_and_refuses_long_text(spark):
    df = spark.createDataFrame([("x" * 10, 1)], "a string, b int")
    contract = T.StructType([T.StructField("name", T.VarcharType(10)), T.StructField("n", T.LongType())])
    assert conform(df, contract).schema.simpleString() == "struct<name:string,n:bigint>"
    assert conform(df, contract).first()["name"] == "x" * 10
    with pytest.raises(Exception, match="longer than 10"):
        conform(df.withColumn("a", F.concat("a", F.lit("y"))), contract).collect()
    with pytest.raises(ValueError):
        conform(df.select("a"), contract)


def test_stages_go_to_the_checkpoint_folder_of_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    staged = stage(spark.range(3), "numbers")
    assert staged.count() == 3
    assert all(f.split("file:")[-1].lstrip("/").startswith(stage_root(spark).split("file:")[-1].lstrip("/")) for f in staged.inputFiles())
    assert folder is None or stage_root(spark).startswith(folder.rstrip("/"))


def test_sources_and_outputs(spark, tmp_path):
    rows = random_warehouse(3, False)
    facts, dims = tmp_path / "facts", tmp_path / "dims"
    for name, df in vars(to_spark(spark, rows)).items():
        df.withColumn("unused", F.lit(1)).write.parquet(f"{dims if name.startswith('dim_') else facts}/{name}.parquet")
    tables = SourceTables.from_directory(spark, str(facts), str(dims))
    assert {n: tuple(df.columns) for n, df in vars(tables).items()} == COLUMNS
    target = str(tmp_path / "out")
    write_output(spark.range(5), target)
    write_output(spark.range(2), target)
    assert spark.read.parquet(target).count() == 2
    lists = code_set(spark.createDataFrame([("a",)], "`ICD-10 CODE` string"), spark.createDataFrame([("a",)], "other string"))
    assert values(lists, "code") == ["a", "a"]


def test_catalog_tables_and_table_output(spark, tmp_path):
    for schema in ("facts", "dims"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS test_{schema} LOCATION '{tmp_path}/{schema}'")
    try:
        for name, df in vars(to_spark(spark, random_warehouse(3, False))).items():
            write_output(df, f"test_{'dims' if name.startswith('dim_') else 'facts'}.{name}", table=True)
        tables = SourceTables.from_catalog(spark, "test_facts", "test_dims")
        assert {n: tuple(df.columns) for n, df in vars(tables).items()} == COLUMNS
        assert tables.dim_icd10.count() == 7
    finally:
        for schema in ("facts", "dims"):
            spark.sql(f"DROP DATABASE test_{schema} CASCADE")


def test_report_lines(spark):
    summary = spark.createDataFrame([(5, 2, 1, 1, 0, 0, 3)], "denominator long, ep_cases long, stage_i long, stage_ii long, stage_iii long, stage_iv long, stage_other long")
    summary = aggregates.add_sums(summary, {"ls_late": ["stage_iii", "stage_iv"]})
    lines = [r["line"] for r in measures.measure_report(summary).collect()]
    assert lines[0] == "Total Cancer Diagnoses: 5" and lines[-1] == 'Stage "Other" Presentations: 3' and len(lines) == 8
    assert [i for i, line in enumerate(lines) if line.startswith("\r\n")] == [1, 2, 3]


def test_study_report_prints_bounds_and_threshold(spark):
    lines = [r["line"] for r in measures.study_report(params_df(spark, StudyParams())).collect()]
    assert lines[0] == "\r\nStep 01 - Search Period Start: 2019-01-01 00:00:00.0000000"
    assert lines[2] == "\r\nStep 02 - Exclusion Period Start: 1969-01-01 00:00:00.0000000"
    assert lines[4] == "\r\nStep 05 - Emergency Care Search Period Start: 2018-12-02 00:00:00.0000000"
    assert lines[-1] == "\r\neStep 02 - Minimum Care History Threshold: 24" and len(lines) == 7


def test_text_is_cast_whole(spark):
    assert one(spark, text.cast_text(F.lit("x" * 40))) == "x" * 40
    with pytest.raises(Exception, match="longer than 30"):
        one(spark, text.cast_text(F.lit("x" * 40), 30))


@pytest.mark.parametrize("span", [0, -1])
def test_spans_of_zero_and_less(spark, span):
    rows = [(1, "2024-01-01 00:00:00.2"), (1, "2024-01-01 00:00:00.7"), (1, "2024-01-01 00:00:01"), (2, None), (None, "2024-01-01 00:00:01")]
    a = spark.createDataFrame(rows, "k int, t string").select("k", F.col("t").cast("timestamp_ntz").alias("t"))
    b = spark.createDataFrame(rows[1:], "k int, t string").select("k", F.col("t").cast("timestamp_ntz").alias("u"))
    equal = 2 if span == 0 else 0
    assert intervals.followed_within(a, b, "k", "t", "u", span).count() == equal
    assert intervals.preceded_within(a, b, "k", "t", "u", span).count() == equal
    assert intervals.asof_latest(a, b, "k", "t", "u", span).count() == intervals.latest_preceding(a, b, "k", "t", "u", span).count()


def test_a_session_without_a_stage_folder_is_an_error():
    session = SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: default),
        sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="local[8]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        stage_root(session)


def test_a_stage_may_name_its_folder(spark, tmp_path):
    assert stage(spark.range(3), "numbers", str(tmp_path)).count() == 3
    assert any(p.name.startswith("numbers-") for p in tmp_path.iterdir())


def test_output_dates_have_no_time(spark):
    assert one(spark, ntz("2000-01-05 23:59:59").cast("date")) == date(2000, 1, 5)
