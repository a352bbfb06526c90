"""Scans, stages, sinks and projections."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from tallyward import schemas
from tallyward.catalog.registry import query, table
from tallyward.functions.predicates import eq_tag
from tallyward.operators.joins import with_dims
from tallyward.operators.projections import distinct_project, project, tag, with_star
from tallyward.operators.setops import union_events
from tallyward.params import StudyParams, params_df, windows
from tallyward.sources.layout import YEAR, in_window, in_years, read_by_year, write_by_year
from tallyward.sources.outputs import read_output, replace_output, write_output
from tallyward.sources.staging import conform, finished, stage, stage_root
from tallyward.sources.tables import code_set, cohort_slice, read_dim, read_source


@query("SELECT l_orderkey, l_partkey, l_shipdate FROM lineitem")
def scan_facts(spark, d):
    return read_source(spark, d, "lineitem", ["l_orderkey", "l_partkey", "l_shipdate"])


@query("""
    SELECT l_orderkey, l_linenumber, p_brand
    FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""")
def scan_dims(spark, d):
    dim = read_dim(spark, d, "part", "p_partkey", ["p_brand"])
    fact = read_source(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey"])
    looked_up = with_dims(
        fact.withColumnRenamed("l_partkey", "p_partkey"), [(dim, "p_partkey", ["p_brand"])]
    )
    return looked_up.select("l_orderkey", "l_linenumber", "p_brand")


@query("""
    SELECT p_brand AS code FROM part WHERE p_size <= 5
    UNION ALL SELECT p_type FROM part WHERE p_size > 45""")
def code_set_union(spark, d):
    part = table(spark, d, "part")
    return code_set(
        part.filter("p_size <= 5").select("p_brand"), part.filter("p_size > 45").select("p_type")
    )


@query("""
    SELECT date_trunc('year', min(o_orderdate))::TIMESTAMP AS Search_Start,
      12::INTEGER AS Search_Length_Months, -50::INTEGER AS Exclude_Length_Years,
      -30::INTEGER AS Lookback_Length_Days, 24::INTEGER AS CareHx_Length_Months
    FROM orders""")
def study_params(spark, d):
    """The parameter row of a study starting in the first year on record."""
    first_year = F.year(F.min("o_orderdate"))
    start = table(spark, d, "orders").agg(
        F.make_date(first_year, F.lit(1), F.lit(1)).cast("timestamp_ntz").alias("start"))
    return conform(params_df(spark, StudyParams(), start.scalar()), schemas.STUDY_PARAMS)


@query("""
    SELECT DISTINCT o_orderdate AS search_start, o_orderdate + INTERVAL 12 MONTH AS search_end,
      o_orderdate - INTERVAL 50 YEAR AS washout_start, o_orderdate AS washout_end,
      o_orderdate - INTERVAL 30 DAY AS emergency_start,
      o_orderdate + INTERVAL 12 MONTH AS emergency_end
    FROM orders""")
def study_windows(spark, d):
    """The windows of studies starting at each order date."""
    w = windows(StudyParams(), F.col("o_orderdate"))
    return distinct_project(
        table(spark, d, "orders"),
        *(
            bound.alias(f"{name}_{end}")
            for name, window in w._asdict().items()
            for end, bound in window._asdict().items()
        ),
    )


@query("""
    SELECT CAST(o_custkey AS VARCHAR) AS PatientSSN, o_custkey AS PatientSID,
      o_orderkey AS ECEventSID, o_orderdate AS ECEventDateTime, o_orderpriority AS TypeOfEvent
    FROM orders""")
def stage_contract(spark, d):
    rows = table(spark, d, "orders").select(
        "o_custkey", F.col("o_custkey").alias("sid"), "o_orderkey", "o_orderdate", "o_orderpriority"
    )
    return stage(conform(rows, schemas.EMERGENCY), "contract")


@query("""
    SELECT l_orderkey AS event_id, l_shipdate AS event_time, 'SHIPPED' AS kind FROM lineitem
    UNION ALL SELECT o_orderkey, o_orderdate, 'ORDERED' FROM orders
    UNION ALL SELECT event_id, ts, upper(event_type) FROM events""")
def append_events(spark, d):
    return union_events(
        tag(project(table(spark, d, "lineitem"), {"l_orderkey": "event_id", "l_shipdate": "event_time"}), kind="SHIPPED"),
        tag(project(table(spark, d, "orders"), {"o_orderkey": "event_id", "o_orderdate": "event_time"}), kind="ORDERED"),
        table(spark, d, "events").select("event_id", F.col("ts").alias("event_time"), F.upper("event_type").alias("kind")),
    )


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def write_cohort(spark, d):
    """Replace an output folder twice and read it back."""
    rows = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    target = f"{stage_root(spark)}/output-{uuid.uuid4().hex}"
    write_output(rows.filter("c_mktsegment = 'BUILDING'"), target)
    write_output(rows, target)
    return spark.read.schema(rows.schema).parquet(target)


def _by_year(spark, rows, time):
    target = f"{stage_root(spark)}/by-year-{uuid.uuid4().hex}"
    write_by_year(rows, target, time)
    return read_by_year(spark, target, rows)


@query("""
    SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
    WHERE l_shipdate BETWEEN TIMESTAMP '1999-12-02' AND TIMESTAMP '2001-01-01'""")
def scan_facts_by_year(spark, d):
    """A fact laid out by year, cut to a closed window."""
    lines = _by_year(spark, read_source(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_shipdate"]), "l_shipdate")
    return in_window(lines, "l_shipdate", windows(StudyParams(search_start=datetime(2000, 1, 1))).emergency).drop(YEAR)


@query("""
    SELECT o_orderkey, o_orderdate FROM orders WHERE year(o_orderdate) IN (
      SELECT DISTINCT year(ts) FROM events WHERE event_type = 'error'
      UNION SELECT min(year(o_orderdate)) FROM orders)""")
def scan_years_of_another_relation(spark, d):
    """Years that only the run can tell: those of some events, and the first on record."""
    orders = read_source(spark, d, "orders", ["o_orderkey", "o_orderdate"])
    years = table(spark, d, "events").filter("event_type = 'error'").select(F.year("ts").alias(YEAR)).unionByName(
        orders.agg(F.min(F.year("o_orderdate")).alias(YEAR)))
    return in_years(_by_year(spark, orders, "o_orderdate"), years).drop(YEAR)


@query("""
    SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'
    UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer""")
def replace_cohort(spark, d):
    """Replace an output while its old version is being read; the new version then reads the old one."""
    rows = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    target = f"{stage_root(spark)}/output-{uuid.uuid4().hex}"
    replace_output(rows.filter("c_mktsegment = 'BUILDING'"), target)
    old = read_output(spark, target)
    replace_output(rows, target)
    replace_output(old.unionByName(read_output(spark, target)), target)
    return read_output(spark, target)


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey")
def finished_stage(spark, d):
    """A stage whose own stages are gone."""
    def build():
        orders = stage(table(spark, d, "orders").select("o_custkey"), "orders")
        return orders.groupBy("o_custkey").agg(F.count("*").alias("n"))

    return finished(build, "counted")


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
    WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')""", name="cohort_slice")
def cohort_slice_by_type(spark, d):
    saved = stage(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"), "saved")
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return cohort_slice(saved, eq_tag("o_orderstatus", "F") & urgent).drop("o_orderpriority")


@query("SELECT c_custkey AS PatientSID, c_name AS PatientName, c_nationkey AS Sta3n FROM customer")
def project_rename(spark, d):
    return project(
        table(spark, d, "customer"),
        {"c_custkey": "PatientSID", "c_name": "PatientName", "c_nationkey": "Sta3n"},
    )


@query("""
    SELECT o_orderkey, 'ZZZ NOT CAPTURED' AS StageOfCancer, 'OUTPATIENT ENCOUNTER' AS TypeOfEvent,
      1::INTEGER AS counted FROM orders""")
def tag_constants(spark, d):
    return tag(
        table(spark, d, "orders").select("o_orderkey"),
        StageOfCancer="ZZZ NOT CAPTURED", TypeOfEvent="OUTPATIENT ENCOUNTER", counted=1,
    )


@query("SELECT *, (p_size + 1)::INTEGER AS next_size FROM part")
def star_plus_derived(spark, d):
    return with_star(table(spark, d, "part"), next_size=F.col("p_size") + 1)


@query("SELECT l_partkey, l_suppkey FROM lineitem GROUP BY l_partkey, l_suppkey", name="distinct_project")
def distinct_project_pairs(spark, d):
    return distinct_project(table(spark, d, "lineitem"), "l_partkey", "l_suppkey")


@query("""
    SELECT o_custkey, o_orderstatus, o_orderpriority FROM (
      SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders
      UNION ALL SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders) AS twice
    GROUP BY ALL""")
def distinct_rows(spark, d):
    rows = table(spark, d, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority")
    return union_events(rows, rows).distinct()
