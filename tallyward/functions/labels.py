"""CASE-style categories and flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyward.functions.predicates import ci
from tallyward.functions.text import _col

# Source spellings and the reported categories.
HISPANIC_SOURCE = "HISPANIC OR LATINO"
WHITE_SOURCES = ("WHITE", "WHITE NOT OF HISP ORIG")
BLACK_SOURCE = "BLACK OR AFRICAN AMERICAN"
HISPANIC, WHITE, BLACK, OTHER = "HISPANIC", "WHITE", "BLACK", "OTHER"


def null_default(c: Column | str, value: int | str) -> Column:
    return F.coalesce(_col(c), F.lit(value))


def is_hispanic(ethnicity: Column | str) -> Column:
    return F.coalesce(ci(ethnicity) == HISPANIC_SOURCE, F.lit(False))


def race_group(race: Column | str) -> Column:
    return (
        F.when(ci(race).isin(*WHITE_SOURCES), WHITE)
        .when(ci(race) == BLACK_SOURCE, BLACK)
        .otherwise(OTHER)
    )


def race_ladder(ethnicity: Column | str, race: Column | str) -> Column:
    """Ethnicity decides first, then race; anything else, NULL included, is OTHER."""
    return F.when(is_hispanic(ethnicity), HISPANIC).otherwise(race_group(race))


def flag_threshold(c: Column | str, op: str, n: int | Column) -> Column:
    """1 when strictly beyond the threshold, else 0 (also for NULL)."""
    limit = n if isinstance(n, Column) else F.lit(n)
    beyond = {">": _col(c) > limit, "<": _col(c) < limit}[op]
    return F.when(beyond, 1).otherwise(0)
