"""Filters and predicates."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tallyward.catalog.registry import query, table
from tallyward.functions import predicates as P
from tallyward.functions.labels import flag_threshold
from tallyward.operators.joins import eligible, route, with_dims
from tallyward.params import Window, ntz_literal

ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderdate")


@query("""
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE o_orderdate >= TIMESTAMP '1999-01-01' AND o_orderdate <= TIMESTAMP '2000-01-01'""")
def between_closed(spark, d):
    lo, hi = ntz_literal(datetime(1999, 1, 1)), ntz_literal(datetime(2000, 1, 1))
    rows = table(spark, d, "orders").filter(P.between_closed("o_orderdate", lo, hi))
    return rows.select("o_orderkey", "o_orderdate")


@query("SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, 'ing|ol')")
def like_contains(spark, d):
    return table(spark, d, "part").filter(P.contains_any("p_name", ["ing", "ol"])).select("p_partkey", "p_name")


@query("SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '^(re|old|hot)')")
def like_prefix(spark, d):
    return table(spark, d, "part").filter(P.prefix_any("p_name", ["re", "old", "hot"])).select("p_partkey", "p_name")


@query("""
    SELECT p_partkey FROM part
    WHERE regexp_matches(p_name, '^(red|PRO)') OR regexp_matches(p_type, '^(red|PRO)')
      OR regexp_matches(nullif(p_brand, 'Brand#7'), '^(red|PRO)')""")
def any_column_prefix(spark, d):
    brand = F.nullif("p_brand", F.lit("Brand#7"))
    matched = P.any_column_prefix(["p_name", "p_type", brand], ["red", "PRO"])
    return table(spark, d, "part").filter(matched).select("p_partkey")


@query("SELECT p_partkey, p_type FROM part WHERE p_type ILIKE 'pro%' OR p_type ILIKE '%Andard'")
def like_case_insensitive(spark, d):
    text = P.ci("p_type")
    matched = P.prefix_any(text, P.fold(["pro"])) | text.like("%Andard".upper())
    return table(spark, d, "part").filter(matched).select("p_partkey", "p_type")


@query("""
    SELECT p_partkey, p_name FROM part
    WHERE NOT regexp_matches(nullif(p_name, 'red bolt'), '^(small|new)|gear$')""")
def not_like_all(spark, d):
    name = F.nullif("p_name", F.lit("red bolt"))
    kept = P.none_like(name, ["small%", "new%", "%gear"])
    return table(spark, d, "part").filter(kept).select("p_partkey", "p_name")


@query("""
    SELECT p_partkey, p_name FROM part
    WHERE NOT regexp_matches(nullif(p_name, 'blue ring'), 'anvil|iz|^red|^large bo|late|od')""")
def not_any_like(spark, d):
    name = F.nullif("p_name", F.lit("blue ring"))
    kept = P.not_any_like(name, ["%anvil%", "%iz%", "red%", "large bo%", "%late%", "%od%"])
    return table(spark, d, "part").filter(kept).select("p_partkey", "p_name")


@query("SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderstatus = 'P'")
def filter_tag(spark, d):
    return table(spark, d, "orders").filter(P.eq_tag("o_orderstatus", "P")).select(*ORDER_COLUMNS)


@query("""
    WITH visits AS (SELECT o_orderkey,
      CASE WHEN o_orderpriority = '5-LOW' THEN -1 WHEN o_orderstatus = 'P' THEN NULL
        ELSE o_custkey END AS site FROM orders)
    SELECT o_orderkey, site FROM visits WHERE site <> -1""")
def filter_sentinel(spark, d):
    site = (
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(-1).cast("bigint"))
        .when(F.col("o_orderstatus") == "P", F.lit(None))
        .otherwise(F.col("o_custkey"))
    )
    visits = table(spark, d, "orders").select("o_orderkey", site.alias("site"))
    return visits.filter(P.not_sentinel("site"))


@query("SELECT p_partkey, p_size FROM part WHERE list_contains([3, 8, 13, 21, 34], p_size)")
def in_list(spark, d):
    return table(spark, d, "part").filter(P.in_list("p_size", (3, 8, 13, 21, 34))).select("p_partkey", "p_size")


@query("""
    WITH sized AS (SELECT p_partkey, CASE WHEN p_type <> 'PROMO' THEN p_size END AS size FROM part)
    SELECT p_partkey, size FROM sized WHERE size IS NULL OR size NOT IN (1, 2, 3, 5, 8, 13)""")
def not_in_list_null_default(spark, d):
    size = F.when(F.col("p_type") != "PROMO", F.col("p_size")).alias("size")
    sized = table(spark, d, "part").select("p_partkey", size)
    return sized.filter(P.not_in_default("size", (1, 2, 3, 5, 8, 13)))


@query("""
    SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem
    WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_name LIKE '%ring%')
       OR l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_name LIKE '%3')""")
def or_over_outer_dims(spark, d):
    rings = table(spark, d, "part").filter(P.contains_any("p_name", ["ring"])).select(
        F.col("p_partkey").alias("l_partkey"), F.lit(True).alias("is_ring"))
    thirds = table(spark, d, "supplier").filter(F.col("s_name").endswith("3")).select(
        F.col("s_suppkey").alias("l_suppkey"), F.lit(True).alias("is_third"))
    looked_up = with_dims(
        table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
        [(rings, "l_partkey", ["is_ring"]), (thirds, "l_suppkey", ["is_third"])],
    )
    hits = looked_up.filter(P.any_flag("is_ring", "is_third"))
    return hits.select("l_orderkey", "l_linenumber").distinct()


@query("""
    SELECT o_orderkey FROM orders
    WHERE coalesce(nullif(o_orderpriority, '5-LOW'), '?') NOT IN ('1-URGENT', '2-HIGH')""")
def other_or_null(spark, d):
    stage = F.nullif("o_orderpriority", F.lit("5-LOW"))
    return table(spark, d, "orders").filter(P.other_or_null(stage, ["1-URGENT", "2-HIGH"])).select("o_orderkey")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F' OR o_orderstatus = 'O'")
def bucket_in(spark, d):
    return table(spark, d, "orders").filter(P.in_bucket("o_orderstatus", ["f", "O"])).select("o_orderkey", "o_orderstatus")


@query("SELECT c_custkey, 1::INTEGER AS rich FROM customer WHERE c_acctbal > 5000")
def filter_flag(spark, d):
    flagged = table(spark, d, "customer").select("c_custkey", flag_threshold("c_acctbal", ">", 5000).alias("rich"))
    return flagged.filter(P.flag_on("rich"))


@query("""
    SELECT l_orderkey, l_linenumber, 'returned open' AS branch FROM lineitem
      WHERE l_returnflag = 'R' AND l_linestatus = 'O'
    UNION ALL SELECT l_orderkey, l_linenumber, 'returned final' FROM lineitem
      WHERE l_returnflag = 'R' AND l_linestatus = 'F'
    UNION ALL SELECT l_orderkey, l_linenumber, 'accepted open' FROM lineitem
      WHERE l_returnflag = 'A' AND l_linestatus = 'O'
    UNION ALL SELECT l_orderkey, l_linenumber, 'accepted final' FROM lineitem
      WHERE l_returnflag = 'A' AND l_linestatus = 'F'""")
def route_by_tags(spark, d):
    branches = {
        ("R", "O"): F.lit("returned open"), ("R", "F"): F.lit("returned final"),
        ("A", "O"): F.lit("accepted open"), ("A", "F"): F.lit("accepted final"),
    }
    routed = route(table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], branches, "branch")
    return routed.select("l_orderkey", "l_linenumber", "branch")


@query("""
    SELECT o_orderkey, o_custkey, o_orderdate FROM orders
    WHERE o_orderdate BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1999-12-31'
      AND o_orderpriority LIKE '1%'
      AND EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment = 'BUILDING')""")
def compound_filter(spark, d):
    cohort = table(spark, d, "customer").filter("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").alias("o_custkey"))
    window = Window(ntz_literal(datetime(1998, 1, 1)), ntz_literal(datetime(1999, 12, 31)))
    kept = eligible(
        table(spark, d, "orders"), "o_orderdate", window,
        P.prefix_any("o_orderpriority", ["1"]), cohort, "o_custkey",
    )
    return kept.select(*ORDER_COLUMNS)
