"""Interval joins: an event followed or preceded by another within a time span.

All add a time bucket to the equality key. A bucket is as wide as the span, so
a partner lies in the row's own bucket or the next one, and a key that owns a
large share of the rows is spread over its buckets instead of meeting itself in
one task. A span of zero asks for equal times, a span below zero for none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.functions.dates import dateadd, time_bucket


def followed_within(
    a: DataFrame, b: DataFrame, key: str, a_end: str, b_time: str, hours: int
) -> DataFrame:
    """Rows of ``a`` with some ``b`` of the same key in ``[end, end + hours]``.

    Only existence is asked for, so no pairs are formed. With buckets as wide as
    the span, any later ``b`` of the own bucket is near enough and any ``b`` of
    the next bucket is late enough: the own bucket's last time and the next
    bucket's first time decide. Those two numbers per bucket are aggregated
    before anything is shuffled.
    """
    if hours <= 0:
        times = b.select(F.col(key).alias("_key"), F.col(b_time).alias("_t")).distinct()
        equal = (F.col(key) == F.col("_key")) & (F.col(a_end) == F.col("_t"))
        return a.join(times, equal & F.lit(hours == 0), "left_semi")
    seconds = hours * 3600
    bucket = time_bucket(F.col(b_time), seconds)
    is_own = F.col("_shift") == 0
    seen = (
        b.select(key, F.col(b_time).alias("_t"), bucket.alias("_b"))
        .withColumn("_shift", F.explode(F.array(F.lit(0), F.lit(1))))
        .groupBy(F.col(key).alias("_key"), (F.col("_b") - F.col("_shift")).alias("_bucket"))
        .agg(
            F.max(F.when(is_own, F.col("_t"))).alias("_last_own"),
            F.min(F.when(~is_own, F.col("_t"))).alias("_first_next"),
        )
    )
    end = F.col(a_end)
    hit = (F.col("_last_own") >= end) | (F.col("_first_next") <= dateadd("HOUR", hours, end))
    probe = a.withColumn("_end_bucket", time_bucket(end, seconds))
    same = (F.col(key) == F.col("_key")) & (F.col("_end_bucket") == F.col("_bucket"))
    return probe.join(seen, same & hit, "left_semi").drop("_end_bucket")


def preceded_within(
    a: DataFrame, b: DataFrame, key: str, a_time: str, b_time: str, days: int
) -> DataFrame:
    """All pairs of ``a`` and ``b`` of one key with ``b`` in ``[a - days, a]``.

    ``b`` contributes its own columns except the key. Full timestamps are
    compared. Each pair meets in exactly one bucket.
    """
    seconds = max(1, days * 86400)
    probe = a.withColumn("_own", time_bucket(F.col(a_time), seconds)).withColumn(
        "_bucket", F.explode(F.array(F.col("_own"), F.col("_own") - 1))
    ).drop("_own")
    build = b.withColumn("_bucket", time_bucket(F.col(b_time), seconds))
    near = F.col(b_time).between(dateadd("DAY", -days, F.col(a_time)), F.col(a_time))
    return probe.join(build, [key, "_bucket"], "inner").filter(near).drop("_bucket")


def latest_preceding(
    a: DataFrame, b: DataFrame, key: str, a_time: str, b_time: str, days: int
) -> DataFrame:
    """The pairs of :func:`preceded_within` with the key's latest ``b``, ties kept.

    Finds the latest time per key from the distinct times of each side (rows of
    a key share few times, so the pairs stay few), then fetches the rows at that
    time only.
    """
    times = preceded_within(
        a.select(key, a_time).distinct(), b.select(key, b_time).distinct(),
        key, a_time, b_time, days,
    )
    latest = times.groupBy(key).agg(F.max(b_time).alias(b_time))
    last_rows = b.join(latest, [key, b_time], "left_semi")
    return preceded_within(a, last_rows, key, a_time, b_time, days)


def asof_latest(
    a: DataFrame, b: DataFrame, key: str, a_time: str, b_time: str, days: int
) -> DataFrame:
    """The same rows as :func:`latest_preceding`, by one merge in time order instead of joins.

    Both sides are laid on one time line per key, the rows of ``b`` at one time as
    one entry, before the rows of ``a`` of that time. The last entry seen is
    carried along, so every row of ``a`` knows the latest ``b`` before it, and no
    pairs are formed. The line is cut at the borders of buckets as wide as the
    span; an entry stands in its own bucket and is carried into the next, where
    the span may still reach it, so a hot key is many tasks. Of a key's rows only
    those with the latest entry are kept, and each task drops the others before
    that shuffle.
    """
    seconds = max(1, days * 86400)
    own = [c for c in b.columns if c != key]
    known = b.filter(F.col(key).isNotNull() & F.col(b_time).isNotNull())
    entries = known.groupBy(F.col(key).alias("_key"), F.col(b_time).alias("_t")).agg(
        F.collect_list(F.struct(*own)).alias("_rows"))
    bucket = time_bucket(F.col("_t"), seconds)
    probe = a.filter(F.col(key).isNotNull() & F.col(a_time).isNotNull()).select(
        F.col(key).alias("_key"), F.col(a_time).alias("_t"), F.struct(*a.columns).alias("_row"))
    early = entries.withColumns({
        "_row": F.lit(None).cast(probe.schema["_row"].dataType),
        "_bucket": F.explode(F.array(bucket, bucket + 1)), "_is_row": F.lit(0),
    })
    late = probe.withColumns({
        "_rows": F.lit(None).cast(entries.schema["_rows"].dataType), "_bucket": bucket, "_is_row": F.lit(1),
    })
    line = early.unionByName(late)
    so_far = Window.partitionBy("_key", "_bucket").orderBy("_t", "_is_row").rowsBetween(Window.unboundedPreceding, 0)
    seen = F.last(F.when(F.col("_is_row") == 0, F.struct("_t", "_rows")), ignorenulls=True).over(so_far)
    near = F.col("_seen._t").between(dateadd("DAY", -days, F.col("_t")), F.col("_t"))
    met = line.withColumn("_seen", seen).filter((F.col("_is_row") == 1) & near)
    place = F.rank().over(Window.partitionBy("_key").orderBy(F.col("_seen._t").desc()))
    return met.withColumn("_place", place).filter(F.col("_place") == 1).select("_row.*", F.inline("_seen._rows"))
