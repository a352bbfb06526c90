"""Date arithmetic that keeps the time of day and counts calendar boundaries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "1970-01-01"


def dateadd(unit: str, n: int | Column, c: Column) -> Column:
    """Shift a timestamp; month ends are clamped and the time of day stays."""
    quantity = n if isinstance(n, Column) else F.lit(n)
    return F.timestamp_add(unit, quantity, c)


def datediff_boundary(unit: str, a: Column, b: Column) -> Column:
    """Month or year boundaries crossed going from ``a`` to ``b`` (signed).

    31 January to 1 February is one month although a day apart; Spark's own
    differences count completed units and would give 0.
    """
    years = F.year(b) - F.year(a)
    if unit == "YEAR":
        return years
    if unit == "MONTH":
        return years * 12 + F.month(b) - F.month(a)
    raise ValueError(f"unsupported unit {unit!r}")


def time_bucket(c: Column, seconds: int) -> Column:
    """Number of the ``seconds``-wide bucket a zone-less timestamp falls in.

    Built from the calendar fields, so a session time zone with daylight
    saving cannot move a row to another bucket.
    """
    days = F.datediff(c.cast("date"), F.lit(_EPOCH).cast("date")).cast("bigint")
    total = days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
    width = F.lit(seconds).cast("bigint")
    return F.call_function("div", total - F.pmod(total, width), width)
