"""Joins with the null, tie and fan-out rules the measures depend on.

No operator carries a broadcast hint: a side is broadcast only when Spark's own
size statistics (file sizes, or AQE's measured stage sizes) are below the
session's threshold, and is shuffled otherwise.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.predicates import between_closed
from tallyward.functions.text import location_label
from tallyward.params import Window


def inner_chain(fact: DataFrame, *links: tuple[DataFrame, str]) -> DataFrame:
    """Inner-join further relations one after the other, each on its key."""
    return reduce(lambda df, link: df.join(link[0], link[1], "inner"), links, fact)


def inner_on(
    df: DataFrame, other: DataFrame, keys: Sequence[str], where: Iterable[Column] = ()
) -> DataFrame:
    """Inner join whose constant ON predicates are applied to ``other`` first."""
    for condition in where:
        other = other.filter(condition)
    return df.join(other, list(keys), "inner")


def with_dims(
    df: DataFrame, dims: Iterable[tuple[DataFrame, str, Sequence[str]]]
) -> DataFrame:
    """Left lookups; each dimension is pruned to its key and wanted columns."""
    for dim, key, cols in dims:
        df = df.join(dim.select(key, *cols), key, "left")
    return df


def left_on(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(other, list(keys), "left")


def lookup_event(df: DataFrame, events: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Left lookup by a surrogate id that may repeat or be missing in ``events``.

    ``events`` is cut to the wanted ids first: a left join cannot broadcast the
    small left side, a semi join can, so a large fact is filtered where it is
    scanned and only the hits travel. Copies of a row collapse before the join.
    """
    wanted = df.select(key).distinct()
    hits = events.select(key, *cols).join(wanted, key, "left_semi").distinct()
    return df.join(hits, key, "left")


def places(stations: DataFrame, states: DataFrame) -> DataFrame:
    """Station to location label; a station without state keeps its city."""
    return (
        stations.select("Sta3n", "City", "StateSID")
        .join(states.select("StateSID", "State"), "StateSID", "left")
        .select("Sta3n", location_label("City", "State").alias("Location"))
    )


def with_place(
    df: DataFrame, station_key: str, stations: DataFrame, states: DataFrame, prefix: str
) -> DataFrame:
    """Two-hop outer lookup; ``prefix`` keeps two roles in one row apart."""
    key = f"{prefix}station"
    role = places(stations, states).select(
        F.col("Sta3n").alias(key), F.col("Location").alias(f"{prefix}location")
    )
    nowhere = location_label(F.lit(None), F.lit(None))
    return (
        df.join(role, df[station_key] == role[key], "left")
        .drop(key)
        .withColumn(f"{prefix}location", F.coalesce(f"{prefix}location", nowhere))
    )


def role_dim(
    df: DataFrame, dim: DataFrame, key: str, dim_key: str, col: str,
    second_key: str | None = None,
) -> DataFrame:
    """Join one dimension in two roles as ``<col>1`` and ``<col>2``.

    Both roles use ``key`` unless a ``second_key`` is named. With one key the
    roles are paired on the dimension, and ``df`` is joined once.
    """
    first = dim.select(F.col(dim_key).alias("_role1"), F.col(col).alias(f"{col}1"))
    second = dim.select(F.col(dim_key).alias("_role2"), F.col(col).alias(f"{col}2"))
    if second_key is None:
        both = first.join(second, F.col("_role1") == F.col("_role2"), "inner")
        return df.join(both, F.col(key) == F.col("_role1"), "inner").drop("_role1", "_role2")
    return (
        df.join(first, F.col(key) == F.col("_role1"), "inner")
        .join(second, F.col(second_key) == F.col("_role2"), "inner")
        .drop("_role1", "_role2")
    )


def expand_identity(
    persons: DataFrame, person_map: DataFrame, events: DataFrame,
    person: str, site: str, real_site: Callable[[str], Column],
) -> DataFrame:
    """Person to all their site ids to all events at any of those sites."""
    sites = person_map.filter(real_site(site)).select(person, site)
    return inner_chain(
        persons, (sites, person), (events.filter(real_site(site)), site)
    )


def semi(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    return df.join(other.select(key).distinct(), key, "left_semi")


def semi_code(df: DataFrame, codes: DataFrame, code: Column, code_col: str = "code") -> DataFrame:
    """Keep the rows whose normalised code is in the code set (which may repeat codes)."""
    listed = codes.select(F.col(code_col).alias("_code"))
    return df.join(listed, code == F.col("_code"), "left_semi")


def common_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct keys present in both; NULL matches nothing."""
    return a.select(key).distinct().join(b.select(key).distinct(), key, "left_semi")


def not_in(
    df: DataFrame, other: DataFrame, key: str, *,
    null_probes: bool = True, null_list: bool = True,
) -> DataFrame:
    """SQL ``NOT IN`` over a list of any size.

    An empty list keeps every row, a NULL in the list drops every row, and
    otherwise the non-NULL keys without a partner stay. The list's state is one
    aggregated number, read as a scalar subquery; the rows meet the list in an
    ordinary shuffle anti join. A caller that knows that neither side holds
    NULL keys says so and saves the extra pass over the list.
    """
    listed = other.select(key)
    kept = df.join(listed.distinct(), key, "left_anti")
    if not null_probes and not null_list:
        return kept
    n, non_null = F.count(F.lit(1)), F.count(key)
    state = listed.agg(
        F.when(n == 0, "empty").when(n == non_null, "plain").otherwise("with null").alias("state")
    ).scalar()
    probe = F.col(key)
    return kept.filter((state == "empty") | ((state == "plain") & probe.isNotNull()))


def rejoin(df: DataFrame, flags: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach flags by key; rows without flags vanish."""
    return df.join(flags.distinct(), list(keys), "inner")


def inner_enrich(df: DataFrame, key: str, *attributes: DataFrame) -> DataFrame:
    """Attach attribute relations that may drop or multiply rows; the result is distinct.

    All sides are reduced to their distinct rows first, which leaves nothing to
    dedupe after the joins: copies never multiply, and AQE may split the joins on
    a hot key, as it may not where a later step relies on their partitioning.
    """
    df = df.distinct()
    for attribute in attributes:
        df = df.join(attribute.distinct(), key, "inner")
    return df


def eligible(
    df: DataFrame, time: str, window: Window, condition: Column, cohort: DataFrame, key: str
) -> DataFrame:
    """In the window, matching the condition, and belonging to the cohort."""
    return semi(df.filter(between_closed(time, *window) & condition), cohort, key)


def route(df: DataFrame, tags: Sequence[str], branches: dict[tuple, Column], name: str) -> DataFrame:
    """One output column chosen by a combination of tags; other rows are dropped.

    The branches are disjoint, so one CASE over one scan replaces one pass per
    branch.
    """

    def tagged(values: tuple) -> Column:
        equal = (F.col(t) == v for t, v in zip(tags, values, strict=True))
        return reduce(lambda a, b: a & b, equal)

    chosen, known = F.lit(None), F.lit(False)
    for values, expr in branches.items():
        chosen = F.when(tagged(values), expr).otherwise(chosen)
        known = known | tagged(values)
    return df.filter(known).withColumn(name, chosen)
