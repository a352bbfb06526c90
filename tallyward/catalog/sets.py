"""First and last rows per key, and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyward.catalog.registry import query, table
from tallyward.operators import firstlast, setops


@query("""
    SELECT DISTINCT l_suppkey, l_orderkey, l_linenumber, l_shipdate FROM lineitem AS a
    WHERE l_shipdate <= ALL (SELECT b.l_shipdate FROM lineitem AS b WHERE b.l_suppkey = a.l_suppkey)""")
def earliest_per_key_ties(spark, d):
    lines = table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_shipdate")
    return firstlast.earliest_per_key(lines, "l_suppkey", "l_shipdate").distinct()


@query("""
    SELECT DISTINCT l_suppkey, l_orderkey, l_linenumber, l_shipdate FROM lineitem AS a
    WHERE l_shipdate >= ALL (SELECT b.l_shipdate FROM lineitem AS b WHERE b.l_suppkey = a.l_suppkey)""")
def latest_per_key_ties(spark, d):
    lines = table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_shipdate")
    return firstlast.latest_per_key(lines, "l_suppkey", "l_shipdate").distinct()


_WITH_NULLS = """
    WITH visit AS (SELECT o_orderkey, nullif(o_custkey, 11) AS person,
      CASE WHEN o_totalprice <= 490000 THEN o_orderdate END AS t FROM orders),
    ranked AS (SELECT *, dense_rank() OVER (PARTITION BY person ORDER BY t {order}) AS place FROM visit)
    SELECT o_orderkey, person, t FROM ranked WHERE place = 1 AND t IS NOT NULL AND person IS NOT NULL"""


def _visits_with_nulls(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", F.nullif(F.col("o_custkey"), F.lit(11).cast("bigint")).alias("person"),
        F.when(F.col("o_totalprice") <= 490000, F.col("o_orderdate")).alias("t"),
    )


@query(_WITH_NULLS.format(order="ASC NULLS FIRST"))
def earliest_per_key_null_time(spark, d):
    """A NULL time comes first, so its person has no earliest row."""
    return firstlast.earliest_per_key(_visits_with_nulls(spark, d), "person", "t")


@query(_WITH_NULLS.format(order="DESC NULLS LAST"))
def latest_per_key_null_time(spark, d):
    return firstlast.latest_per_key(_visits_with_nulls(spark, d), "person", "t")


@query("""
    SELECT l_partkey AS item, l_suppkey AS place FROM lineitem
    UNION SELECT o_custkey, o_orderkey FROM orders""")
def union_distinct(spark, d):
    return setops.union_distinct(
        table(spark, d, "lineitem").select(F.col("l_partkey").alias("item"), F.col("l_suppkey").alias("place")),
        table(spark, d, "orders").select(F.col("o_custkey").alias("item"), F.col("o_orderkey").alias("place")),
    )


@query("""
    SELECT DISTINCT o_custkey, o_orderstatus FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 2000)""")
def difference_by_key(spark, d):
    poor = table(spark, d, "customer").filter("c_acctbal < 2000").select(F.col("c_custkey").alias("o_custkey"))
    return setops.difference_by_key(table(spark, d, "orders").select("o_custkey", "o_orderstatus"), poor, "o_custkey")


@query("""
    SELECT DISTINCT o_custkey, o_orderpriority, o_orderkey FROM orders
    WHERE o_orderpriority = '1-URGENT' OR o_custkey NOT IN (
      SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
    name="prefer_source")
def prefer_source_orders(spark, d):
    orders = table(spark, d, "orders").select("o_custkey", "o_orderpriority", "o_orderkey")
    return setops.prefer_source(orders, "o_custkey", "o_orderpriority", "1-URGENT")
