"""Filter conditions. All follow SQL three-valued logic unless noted."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyward.functions.text import _col

SENTINEL = -1


def ci(c: Column | str) -> Column:
    """Comparison form of a text: case and trailing blanks do not count."""
    return F.upper(F.rtrim(_col(c)))


def between_closed(c: Column | str, lo: Column, hi: Column) -> Column:
    return _col(c).between(lo, hi)


def contains_any(c: Column | str, patterns: Iterable[str]) -> Column:
    return _any(_col(c).contains(p) for p in patterns)


def prefix_any(c: Column | str, patterns: Iterable[str]) -> Column:
    return _any(_col(c).startswith(p) for p in patterns)


def any_column_prefix(cols: Iterable[Column | str], patterns: Iterable[str]) -> Column:
    patterns = list(patterns)
    return _any(prefix_any(c, patterns) for c in cols)


def none_like(c: Column | str, patterns: Iterable[str]) -> Column:
    """No pattern matches; a NULL text does not qualify."""
    return reduce(and_, (~_col(c).like(p) for p in patterns))


def not_any_like(c: Column | str, patterns: Iterable[str]) -> Column:
    return ~_any(_col(c).like(p) for p in patterns)


def eq_tag(c: Column | str, value: str) -> Column:
    return _col(c) == F.lit(value)


def not_sentinel(c: Column | str, value: int = SENTINEL) -> Column:
    """A real key: neither the sentinel nor NULL."""
    return _col(c) != F.lit(value)


def in_list(c: Column | str, values: Iterable) -> Column:
    return _col(c).isin(list(values))


def not_in_default(c: Column | str, values: Iterable, default: int = 0) -> Column:
    """Not in the list, a NULL standing for ``default`` (so it is kept)."""
    return ~F.coalesce(_col(c), F.lit(default)).isin(list(values))


def any_flag(*cols: Column | str) -> Column:
    """At least one flag set; the NULL flag of an unmatched outer join is unset."""
    return _any(F.coalesce(_col(c), F.lit(False)) for c in cols)


def in_bucket(c: Column | str, values: Iterable[str]) -> Column:
    return ci(c).isin([v.upper() for v in values])


def other_or_null(c: Column | str, known: Iterable[str]) -> Column:
    return ~in_bucket(c, known) | _col(c).isNull()


def flag_on(c: Column | str) -> Column:
    return _col(c) == F.lit(1)


def fold(patterns: Iterable[str]) -> list[str]:
    """Patterns in the comparison form of :func:`ci`."""
    return [p.upper() for p in patterns]


def _any(conditions: Iterable[Column]) -> Column:
    combine: Callable[[Column, Column], Column] = or_
    return reduce(combine, conditions)
