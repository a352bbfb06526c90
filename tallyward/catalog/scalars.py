"""Scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyward.catalog.registry import query, table
from tallyward.functions import dates, labels, text


@query("""
    SELECT o_orderkey,
      coalesce(nullif(o_orderpriority, '5-LOW'), '') || ' OF THE ' || o_orderstatus AS label
    FROM orders""")
def concat_null_empty(spark, d):
    priority = F.nullif("o_orderpriority", F.lit("5-LOW"))
    label = text.concat_null_empty(priority, F.lit(" OF THE "), "o_orderstatus")
    return table(spark, d, "orders").select("o_orderkey", label.alias("label"))


@query("SELECT c_custkey, '''' || c_custkey || '''' AS quoted FROM customer")
def quote_wrap(spark, d):
    return table(spark, d, "customer").select("c_custkey", text.quote_wrap("c_custkey").alias("quoted"))


@query("""
    SELECT n_nationkey,
      '''' || n_name || ', ''' || CASE WHEN r_name = 'ASIA' THEN '' ELSE r_name END AS location
    FROM nation JOIN region ON r_regionkey = n_regionkey""")
def location_label(spark, d):
    region = table(spark, d, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    placed = table(spark, d, "nation").join(region, "n_regionkey")
    state = F.nullif("r_name", F.lit("ASIA"))
    return placed.select("n_nationkey", text.location_label("n_name", state).alias("location"))


@query("""
    SELECT o_orderkey, chr(13) || chr(10) || 'Order of: '
      || nullif(substr(CAST(o_custkey AS VARCHAR), 1, 30), '7') AS line FROM orders""")
def report_line(spark, d):
    customer = F.nullif(F.col("o_custkey"), F.lit(7).cast("bigint"))
    line = text.report_line("Order of", customer, leading_break=True)
    return table(spark, d, "orders").select("o_orderkey", line.alias("line"))


@query("""
    SELECT p_partkey, array_to_string(string_split(CAST(p_size AS VARCHAR) || '.' || p_type || '.', '.'), '') AS code
    FROM part""")
def strip_dots(spark, d):
    dotted = F.concat(F.col("p_size").cast("string"), F.lit("."), "p_type", F.lit("."))
    return table(spark, d, "part").select("p_partkey", text.strip_dots(dotted).alias("code"))


@query("SELECT event_id, date_trunc('day', ts)::DATE AS event_date FROM events")
def cast_date(spark, d):
    return table(spark, d, "events").select("event_id", F.col("ts").cast("date").alias("event_date"))


@query("""
    SELECT event_id, CAST(user_id AS VARCHAR) AS user_text,
      event_type || ' of user ' || props || ' in the log' AS event_text FROM events""")
def cast_string(spark, d):
    long_text = F.concat("event_type", F.lit(" of user "), "props", F.lit(" in the log"))
    return table(spark, d, "events").select(
        "event_id", text.cast_text("user_id").alias("user_text"),
        text.cast_text(long_text).alias("event_text"),
    )


@query("SELECT event_id, ts - INTERVAL 30 DAY AS shifted FROM events")
def dateadd_day(spark, d):
    return table(spark, d, "events").select("event_id", dates.dateadd("DAY", -30, F.col("ts")).alias("shifted"))


@query("SELECT o_orderkey, o_orderdate + INTERVAL 13 MONTH AS shifted FROM orders")
def dateadd_month(spark, d):
    return table(spark, d, "orders").select("o_orderkey", dates.dateadd("MONTH", 13, F.col("o_orderdate")).alias("shifted"))


@query("SELECT o_orderkey, o_orderdate - INTERVAL 50 YEAR AS shifted FROM orders")
def dateadd_year(spark, d):
    return table(spark, d, "orders").select("o_orderkey", dates.dateadd("YEAR", -50, F.col("o_orderdate")).alias("shifted"))


@query("SELECT event_id, ts + INTERVAL 24 HOUR AS shifted FROM events")
def dateadd_hour(spark, d):
    return table(spark, d, "events").select("event_id", dates.dateadd("HOUR", 24, F.col("ts")).alias("shifted"))


@query("""
    SELECT l_orderkey, l_linenumber, l_shipdate,
      CAST(date_diff('month', o_orderdate, l_shipdate) AS INTEGER) AS months
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def datediff_month_boundary(spark, d):
    return _order_lines(spark, d).select(
        "l_orderkey", "l_linenumber", "l_shipdate",
        dates.datediff_boundary("MONTH", F.col("o_orderdate"), F.col("l_shipdate")).alias("months"),
    )


@query("""
    SELECT l_orderkey, l_linenumber, l_shipdate,
      CAST(date_diff('year', o_orderdate, l_shipdate) AS INTEGER) AS years
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def datediff_year_boundary(spark, d):
    return _order_lines(spark, d).select(
        "l_orderkey", "l_linenumber", "l_shipdate",
        dates.datediff_boundary("YEAR", F.col("o_orderdate"), F.col("l_shipdate")).alias("years"),
    )


def _order_lines(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return table(spark, d, "lineitem").join(orders, "l_orderkey")


@query("SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 0 ELSE p_size END::INTEGER AS size FROM part")
def null_default(spark, d):
    size = F.when(F.col("p_type") != "PROMO", F.col("p_size"))
    return table(spark, d, "part").select("p_partkey", labels.null_default(size, 0).alias("size"))


@query("""
    WITH person AS (SELECT c_custkey,
        CASE c_nationkey % 3 WHEN 0 THEN 'HISPANIC OR LATINO' WHEN 1 THEN 'NOT HISPANIC' END AS eth,
        CASE c_mktsegment WHEN 'MACHINERY' THEN 'WHITE' WHEN 'BUILDING' THEN 'WHITE NOT OF HISP ORIG'
          WHEN 'FURNITURE' THEN 'BLACK OR AFRICAN AMERICAN' WHEN 'HOUSEHOLD' THEN 'ASIAN' END AS race
      FROM customer)
    SELECT c_custkey, CASE WHEN eth = 'HISPANIC OR LATINO' THEN 'HISPANIC'
      ELSE coalesce(map {'WHITE': 'WHITE', 'WHITE NOT OF HISP ORIG': 'WHITE',
        'BLACK OR AFRICAN AMERICAN': 'BLACK'}[race], 'OTHER') END AS race_label
    FROM person""")
def case_ladder(spark, d):
    nation = F.col("c_nationkey") % 3
    ethnicity = F.when(nation == 0, "HISPANIC OR LATINO").when(nation == 1, "NOT HISPANIC")
    segment = F.col("c_mktsegment")
    race = (
        F.when(segment == "MACHINERY", "WHITE")
        .when(segment == "BUILDING", "WHITE NOT OF HISP ORIG")
        .when(segment == "FURNITURE", "BLACK OR AFRICAN AMERICAN")
        .when(segment == "HOUSEHOLD", "ASIAN")
    )
    return table(spark, d, "customer").select("c_custkey", labels.race_ladder(ethnicity, race).alias("race_label"))


@query("""
    SELECT p_partkey, coalesce(size > 24, false)::INTEGER AS above, coalesce(size < 24, false)::INTEGER AS below
    FROM (SELECT p_partkey, nullif(p_size, 30) AS size FROM part) AS sized""")
def case_flag_threshold(spark, d):
    size = F.nullif(F.col("p_size"), F.lit(30))
    return table(spark, d, "part").select(
        "p_partkey",
        labels.flag_threshold(size, ">", 24).alias("above"),
        labels.flag_threshold(size, "<", 24).alias("below"),
    )
