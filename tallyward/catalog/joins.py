"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyward.catalog.registry import query, table
from tallyward.functions.predicates import ci, not_sentinel
from tallyward.functions.text import strip_dots
from tallyward.operators import intervals, joins as J
from tallyward.operators.projections import project
from tallyward.params import StudyParams, params_df


def _orders(spark, d, *extra):
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", *extra)


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, o_custkey, c_name
    FROM customer, orders, lineitem WHERE c_custkey = o_custkey AND o_orderkey = l_orderkey""")
def inner_join_chain(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    orders = project(_orders(spark, d), {"o_orderkey": "l_orderkey", "o_custkey": "o_custkey"})
    persons = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return J.inner_chain(lines, (orders, "l_orderkey"), (persons, "o_custkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "o_custkey", "c_name")


@query("""
    SELECT l_orderkey, l_linenumber,
      (SELECT min(p_brand) FROM part WHERE p_partkey = l_partkey AND p_type = 'PROMO') AS p_brand,
      (SELECT min(s_name) FROM supplier WHERE s_suppkey = l_suppkey AND s_nationkey < 5) AS s_name
    FROM lineitem""")
def left_join_dims(spark, d):
    parts = table(spark, d, "part").filter("p_type = 'PROMO'").withColumnRenamed("p_partkey", "l_partkey")
    suppliers = table(spark, d, "supplier").filter("s_nationkey < 5").withColumnRenamed("s_suppkey", "l_suppkey")
    looked_up = J.with_dims(
        table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
        [(parts, "l_partkey", ["p_brand"]), (suppliers, "l_suppkey", ["s_name"])],
    )
    return looked_up.select("l_orderkey", "l_linenumber", "p_brand", "s_name")


@query("""
    WITH dx AS (
      SELECT l_orderkey AS event_id, o_custkey AS site, l_shipdate AS t
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey
      UNION ALL SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderstatus = 'P')
    SELECT dx.event_id, dx.site, dx.t, o_orderpriority FROM dx LEFT JOIN orders
      ON o_orderkey = dx.event_id AND o_custkey = dx.site AND o_orderdate = dx.t""")
def left_join_multikey(spark, d):
    registry = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("event_id"), F.col("o_custkey").alias("site"),
        F.col("o_orderdate").alias("t"), "o_orderpriority", "o_orderstatus",
    )
    shipped = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("event_id"), F.col("l_shipdate").alias("t"))
    dx = (
        shipped.join(registry.select("event_id", "site"), "event_id").select("event_id", "site", "t")
        .unionByName(registry.filter("o_orderstatus = 'P'").select("event_id", "site", "t"))
    )
    return J.left_on(dx, registry.drop("o_orderstatus"), ["event_id", "site", "t"])


def _stations(spark, d):
    stations = table(spark, d, "nation").select(
        F.col("n_nationkey").alias("Sta3n"), F.col("n_name").alias("City"),
        F.when(F.col("n_regionkey") != 2, F.col("n_regionkey")).alias("StateSID"),
    )
    states = project(table(spark, d, "region"), {"r_regionkey": "StateSID", "r_name": "State"})
    return stations, states


@query("""
    WITH place AS (SELECT n_nationkey, '''' || n_name || ', ''' || coalesce(r_name, '') AS label
      FROM nation LEFT JOIN region ON r_regionkey = n_regionkey AND n_regionkey <> 2)
    SELECT c_custkey, coalesce(label, ''', ''') AS c_location
    FROM customer LEFT JOIN place ON n_nationkey = c_nationkey AND c_acctbal > 0""")
def two_hop_lookup(spark, d):
    rows = table(spark, d, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_nationkey")).alias("station"))
    return J.with_place(rows, "station", *_stations(spark, d), "c_").drop("station")


@query("""
    SELECT l_orderkey, l_linenumber, one.p_size AS p_size1, two.p_size AS p_size2
    FROM lineitem JOIN part AS one ON one.p_partkey = l_partkey
      JOIN part AS two ON two.p_partkey = l_partkey
    WHERE one.p_size < 10 AND coalesce(two.p_size, 0) <> 5""")
def role_playing_dim(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    roles = J.role_dim(lines, table(spark, d, "part"), "l_partkey", "p_partkey", "p_size")
    kept = roles.filter((F.col("p_size1") < 10) & (F.coalesce("p_size2", F.lit(0)) != 5))
    return kept.drop("l_partkey")


@query("""
    SELECT l_orderkey, l_linenumber, one.p_size AS p_size1, two.p_size AS p_size2
    FROM lineitem JOIN part AS one ON one.p_partkey = l_partkey
      JOIN part AS two ON two.p_partkey = l_suppkey""")
def role_playing_dim_second_key(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    roles = J.role_dim(lines, table(spark, d, "part"), "l_partkey", "p_partkey", "p_size", "l_suppkey")
    return roles.drop("l_partkey", "l_suppkey")


@query("""
    WITH place AS (SELECT n_nationkey, '''' || n_name || ', ''' || coalesce(r_name, '') AS label
      FROM nation LEFT JOIN region ON r_regionkey = n_regionkey AND n_regionkey <> 2)
    SELECT l_orderkey, l_linenumber, dx.label AS dx_location, ec.label AS ec_location
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN orders ON o_orderkey = l_orderkey
      JOIN customer ON c_custkey = o_custkey
      JOIN place AS dx ON dx.n_nationkey = s_nationkey JOIN place AS ec ON ec.n_nationkey = c_nationkey""")
def dual_role_location(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    suppliers = project(table(spark, d, "supplier"), {"s_suppkey": "l_suppkey", "s_nationkey": "dx"})
    orders = project(_orders(spark, d), {"o_orderkey": "l_orderkey", "o_custkey": "o_custkey"})
    customers = project(table(spark, d, "customer"), {"c_custkey": "o_custkey", "c_nationkey": "ec"})
    rows = J.inner_chain(lines, (suppliers, "l_suppkey"), (orders, "l_orderkey"), (customers, "o_custkey"))
    places = _stations(spark, d)
    both = J.with_place(J.with_place(rows, "dx", *places, "dx_"), "ec", *places, "ec_")
    return both.select("l_orderkey", "l_linenumber", "dx_location", "ec_location")


@query("""
    SELECT o_orderkey, c_name FROM orders JOIN customer
      ON c_custkey = o_custkey AND c_nationkey <> 3 AND c_acctbal > 100""")
def join_on_with_const(spark, d):
    persons = table(spark, d, "customer").withColumnRenamed("c_custkey", "o_custkey")
    where = [not_sentinel("c_nationkey", 3), F.col("c_acctbal") > 100]
    return J.inner_on(_orders(spark, d), persons, ["o_custkey"], where).select("o_orderkey", "c_name")


@query("""
    WITH person AS (SELECT DISTINCT n_nationkey AS ssn FROM nation WHERE n_regionkey < 3),
      spatient AS (SELECT c_nationkey AS ssn, coalesce(nullif(c_custkey, 7), -1) AS sid FROM customer),
      visit AS (SELECT o_orderkey, coalesce(nullif(o_custkey, 7), -1) AS sid FROM orders)
    SELECT person.ssn, spatient.sid, o_orderkey FROM person JOIN spatient USING (ssn) JOIN visit USING (sid)
    WHERE spatient.sid <> -1 AND visit.sid <> -1""")
def identity_expansion(spark, d):
    sentinel = lambda c: F.coalesce(F.nullif(F.col(c), F.lit(7).cast("bigint")), F.lit(-1).cast("bigint"))
    persons = table(spark, d, "nation").filter("n_regionkey < 3").select(F.col("n_nationkey").alias("ssn"))
    spatient = table(spark, d, "customer").select(F.col("c_nationkey").alias("ssn"), sentinel("c_custkey").alias("sid"))
    visits = table(spark, d, "orders").select("o_orderkey", sentinel("o_custkey").alias("sid"))
    return J.expand_identity(persons, spatient, visits, "ssn", "sid", not_sentinel).select("ssn", "sid", "o_orderkey")


@query("""
    SELECT a.event_id FROM events a WHERE a.event_type = 'error' AND EXISTS (
      SELECT 1 FROM events b WHERE b.event_type = 'purchase' AND b.user_id = a.user_id
        AND b.ts >= a.ts AND b.ts <= a.ts + INTERVAL 24 HOUR)""")
def interval_join_followup(spark, d):
    events = table(spark, d, "events")
    errors = events.filter("event_type = 'error'").select("event_id", "user_id", "ts")
    bought = events.filter("event_type = 'purchase'").select("user_id", F.col("ts").alias("bought_at"))
    followed = intervals.followed_within(errors, bought, "user_id", "ts", "bought_at", 24)
    return followed.select("event_id")


@query("""
    SELECT dx.event_id AS signup_id, ec.event_id AS error_id, dx.user_id, ec.ts AS error_at
    FROM events dx JOIN events ec ON ec.user_id = dx.user_id
    WHERE dx.event_type = 'signup' AND ec.event_type = 'error'
      AND ec.ts BETWEEN dx.ts - INTERVAL 3 DAY AND dx.ts""")
def interval_join_lookback(spark, d):
    events = table(spark, d, "events")
    signups = events.filter("event_type = 'signup'").select(F.col("event_id").alias("signup_id"), "user_id", "ts")
    errors = events.filter("event_type = 'error'").select(
        F.col("event_id").alias("error_id"), "user_id", F.col("ts").alias("error_at"))
    return intervals.preceded_within(signups, errors, "user_id", "ts", "error_at", 3).drop("ts")


_LATEST = """
    WITH pair AS (SELECT dx.event_id AS signup_id, ec.event_id AS error_id, dx.user_id, ec.ts AS error_at
      FROM events dx JOIN events ec ON ec.user_id = dx.user_id
      WHERE dx.event_type = 'signup' AND ec.event_type = 'error'
        AND ec.ts BETWEEN dx.ts - INTERVAL 3 DAY AND dx.ts)
    SELECT p.* FROM pair p
    WHERE p.error_at >= ALL (SELECT q.error_at FROM pair q WHERE q.user_id = p.user_id)"""


def _signups_and_errors(spark, d):
    events = table(spark, d, "events")
    signups = events.filter("event_type = 'signup'").select(F.col("event_id").alias("signup_id"), "user_id", "ts")
    return signups, events.filter("event_type = 'error'").select(
        F.col("event_id").alias("error_id"), "user_id", F.col("ts").alias("error_at"))


@query(_LATEST)
def interval_join_latest(spark, d):
    return intervals.latest_preceding(*_signups_and_errors(spark, d), "user_id", "ts", "error_at", 3).drop("ts")


@query(_LATEST)
def asof_latest(spark, d):
    """The same by a merge in time order."""
    return intervals.asof_latest(*_signups_and_errors(spark, d), "user_id", "ts", "error_at", 3).drop("ts")


@query("""
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')""")
def semi_join_in(spark, d):
    cohort = table(spark, d, "customer").filter("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("o_custkey"))
    return J.semi(_orders(spark, d), cohort, "o_custkey")


def _probe_and_list(spark, d, condition):
    """Users with a NULL among them, and those with errors before a time."""
    events = table(spark, d, "events")
    probe = events.filter("event_type = 'view'").select(
        "event_id", F.nullif(F.col("user_id"), F.lit(5).cast("bigint")).alias("user_id"))
    listed = events.filter("event_type = 'error'").filter(condition)
    return probe, listed


_PROBE = "SELECT event_id, nullif(user_id, 5) AS user_id FROM events WHERE event_type = 'view'"


@query(f"""
    SELECT event_id, user_id FROM ({_PROBE}) AS probe WHERE user_id NOT IN (
      SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def null_aware_anti(spark, d):
    probe, _ = _probe_and_list(spark, d, "TRUE")
    urgent = table(spark, d, "orders").filter("o_orderpriority = '1-URGENT'")
    return J.not_in(probe, urgent.select(F.col("o_custkey").alias("user_id")), "user_id")


@query(f"""
    SELECT event_id, user_id FROM ({_PROBE}) AS probe WHERE user_id NOT IN (
      SELECT nullif(user_id, 8) FROM events WHERE event_type = 'error')""")
def null_aware_anti_null_in_list(spark, d):
    probe, listed = _probe_and_list(spark, d, "TRUE")
    return J.not_in(probe, listed.select(F.nullif(F.col("user_id"), F.lit(8).cast("bigint")).alias("user_id")), "user_id")


@query(f"""
    SELECT event_id, user_id FROM ({_PROBE}) AS probe WHERE user_id NOT IN (
      SELECT user_id FROM events WHERE event_type = 'error' AND ts < TIMESTAMP '2023-01-01')""")
def null_aware_anti_empty_list(spark, d):
    probe, listed = _probe_and_list(spark, d, "ts < TIMESTAMP_NTZ '2023-01-01'")
    return J.not_in(probe, listed.select("user_id"), "user_id")


@query("""
    SELECT l_orderkey, l_linenumber, p_brand FROM lineitem JOIN part ON p_partkey = l_partkey
    WHERE replace(p_brand, '#', '') IN (SELECT 'Brand' || p_size FROM part WHERE p_size <= 10)""")
def semi_join_normalized_code(spark, d):
    part = table(spark, d, "part")
    codes = part.filter("p_size <= 10").select(F.upper(F.concat(F.lit("Brand"), "p_size")).alias("code"))
    normalised = strip_dots(F.replace(F.col("p_brand"), F.lit("#"), F.lit(".")))
    listed = J.semi_code(part, codes, ci(normalised)).select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return J.inner_chain(lines, (listed, "l_partkey")).drop("l_partkey")


@query("""
    SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'
    INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'""")
def common_keys(spark, d):
    orders = table(spark, d, "orders")
    return J.common_keys(
        orders.filter("o_orderpriority = '1-URGENT'").select("o_custkey"),
        orders.filter("o_orderstatus = 'P'").select("o_custkey"), "o_custkey",
    )


@query("""
    SELECT DISTINCT c_custkey, c_name, race.value AS race, eth.value AS ethnicity
    FROM customer JOIN events race ON race.user_id = c_custkey JOIN events eth ON eth.user_id = c_custkey
    WHERE race.event_type = 'error' AND eth.event_type = 'view'""")
def inner_enrich_fanout(spark, d):
    events = table(spark, d, "events")
    attribute = lambda kind, name: events.filter(F.col("event_type") == kind).select(
        F.col("user_id").alias("c_custkey"), F.col("value").alias(name))
    persons = table(spark, d, "customer").select("c_custkey", "c_name")
    return J.inner_enrich(persons, "c_custkey", attribute("error", "race"), attribute("view", "ethnicity"))


@query("""
    SELECT DISTINCT o_custkey, o_orderkey, (l_quantity > 45)::INTEGER AS bulky
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'""")
def rejoin_flags(spark, d):
    orders = _orders(spark, d)
    lines = table(spark, d, "lineitem").filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.when(F.col("l_quantity") > 45, 1).otherwise(0).alias("bulky"),
    )
    flags = J.inner_chain(lines, (orders, "o_orderkey"))
    return J.rejoin(orders, flags, ["o_custkey", "o_orderkey"]).select("o_custkey", "o_orderkey", "bulky")


@query("""
    WITH wanted AS (SELECT DISTINCT l_orderkey * 2 AS event_id FROM lineitem)
    SELECT event_id, o_custkey AS station FROM wanted LEFT JOIN orders ON o_orderkey = event_id""")
def left_lookup_event(spark, d):
    wanted = table(spark, d, "lineitem").select((F.col("l_orderkey") * 2).alias("event_id")).distinct()
    events = project(_orders(spark, d), {"o_orderkey": "event_id", "o_custkey": "station"})
    return J.lookup_event(wanted, events, "event_id", ["station"])


@query("""
    SELECT o_orderkey, o_orderdate, o_orderdate + INTERVAL 1 DAY * (-30) AS lookback_start
    FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01' - INTERVAL 1 MONTH * 12""")
def scalar_subquery_param(spark, d):
    """Parameters read from the one-row relation as scalar subqueries."""
    params = params_df(spark, StudyParams())
    days = params.select("Lookback_Length_Days").scalar()
    months = params.select("Search_Length_Months").scalar()
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    start = F.timestamp_add("MONTH", -months, F.lit("2000-01-01").cast("timestamp_ntz"))
    return orders.filter(F.col("o_orderdate") >= start).withColumn(
        "lookback_start", F.timestamp_add("DAY", days, F.col("o_orderdate")))
