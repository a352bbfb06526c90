"""Distinct counts by bitmaps against sets, period by period."""

from __future__ import annotations

import random
from pathlib import Path

from pyspark.sql import functions as F

from tallyward.operators import bitmaps
from test_queries import plan

MEMBERS = {"a": {"a"}, "b": {"b"}, "late": {"b", "c"}, "none": set()}


class Strata(dict):
    """Conditions need a session, so they are made when asked for."""

    def items(self):
        return [(name, F.col("s").isin(sorted(members) or ["zz"])) for name, members in MEMBERS.items()]


STRATA = Strata.fromkeys(MEMBERS)


def made(seed, n):
    rng = random.Random(seed)
    numbers = [None, 0, 1, 32_767, 32_768, 32_769, 65_536, 10**12, *range(200)]
    return [(rng.choice(numbers), rng.choice(["a", "b", "c", None])) for _ in range(n)]


def expected(rows):
    return tuple(len({n for n, s in rows if n is not None and s in MEMBERS[name]}) for name in STRATA)


def test_counts_equal_sets_and_periods_merge(spark, tmp_path):
    target, seen = str(tmp_path / "counts"), []
    for period in ("1999", "2000", "2001"):
        rows = made(period, 400)
        seen += rows
        own = bitmaps.strata_bitmaps(spark.createDataFrame(rows, "n long, s string").repartition(3), "n", STRATA)
        assert tuple(bitmaps.counted(own, list(STRATA)).first()) == expected(rows)
        before = {p: p.stat().st_mtime_ns for p in Path(target).rglob("*.parquet")} if Path(target).exists() else {}
        bitmaps.add_period(own, target, period)
        assert all(p.stat().st_mtime_ns == t for p, t in before.items()), "old periods are not written again"
        stored = bitmaps.periods(own, target)
        assert tuple(bitmaps.counted(bitmaps.merged(stored), list(STRATA)).first()) == expected(seen)
    assert stored.select("period").distinct().count() == 3
    replaced = bitmaps.strata_bitmaps(spark.createDataFrame([(5, "a")], "n long, s string"), "n", STRATA)
    bitmaps.add_period(replaced, target, "2000")
    rest = [r for p in ("1999", "2001") for r in made(p, 400)]
    assert tuple(bitmaps.counted(bitmaps.merged(bitmaps.periods(own, target)), list(STRATA)).first()) == expected([*rest, (5, "a")])
    text = plan(bitmaps.counted(bitmaps.merged(bitmaps.periods(own, target)), list(STRATA)))
    assert text.count("Scan parquet") == 2 and "counts" in text, "only the stored bitmaps are read"


def test_nothing_to_count(spark):
    none = spark.createDataFrame([], "n long, s string")
    assert tuple(bitmaps.counted(bitmaps.merged(bitmaps.strata_bitmaps(none, "n", STRATA)), list(STRATA)).first()) == (0,) * 4


def test_numbers_are_distinct_and_kept(spark):
    first = spark.createDataFrame([("x",), ("y",), ("x",), (None,)], "p string")
    known = bitmaps.numbered(first, "p")
    again = bitmaps.numbered(spark.createDataFrame([("y",), ("z",), ("w",)], "p string"), "p", known)
    old, new = ({r["p"]: r["number"] for r in df.collect()} for df in (known, again))
    assert set(old) == {"x", "y"} and set(new) == {"w", "x", "y", "z"}
    assert all(new[p] == n for p, n in old.items()) and len(set(new.values())) == 4
    assert bitmaps.numbered(first.limit(0), "p").count() == 0
