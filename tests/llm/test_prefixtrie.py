"""The prefix trie against plain dictionaries, in tasks and split by Spark."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings, strategies as st

import __spark_entry__ as driver
from compare import connect, spark_rows, sql_rows, type_differences
from tallyward.llm import prefixtrie as p


def brute(rows, branch=True):
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of each node."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(t, key=lambda x: x[:2])] for c, t in own.items()}
    if branch:
        def share(c):
            return zlib.crc32(str(c).encode()) % 6
        turns = {c: tuple(turns.get(c - c % 100, [])[:share(c)] + t[share(c):]) for c, t in turns.items()}
    members = defaultdict(list)
    for c, t in turns.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
    children = defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, convs in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += children[path] == 0
            saved[path[:d]] += (len(convs) - 1) * len(path[-1][1]) if path else 0
    return sorted((
        min(convs), len(path), min(members[path[:-1]]) if path else -1, len(convs), children[path], leaves[path], saved[path],
        hashlib.sha256(",".join(str(c) for c in sorted(convs) if len(turns[c]) == len(path)).encode()).hexdigest(),
    ) for path, convs in members.items())


def rows_of(found):
    return sorted(tuple(-1 if x is None else x for x in r) for r in found.collect())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**6), st.integers(0, 9), st.integers(0, 9)), min_size=1, max_size=60))
def test_centroids_give_subtree_sums(draws):
    parents = [-1 if not i else draw[0] % i for i, draw in enumerate(draws)]
    values = [[d[1] for d in draws], [d[2] for d in draws]]
    expected = [list(v) for v in values]
    for i in range(len(draws) - 1, 0, -1):
        for e in expected:
            e[parents[i]] += e[i]
    assert p.rolled(parents, [0], values) == expected
    twice = [*parents, -1, *(x + len(draws) for x in parents[1:])]
    assert p.rolled(twice, [0, len(draws)], [v * 2 for v in values]) == [e * 2 for e in expected]


def made(rng):
    """Branching conversations, copies, a very long one, and one with a third of all rows."""
    rows = []
    for c in range(130):
        for t in range(rng.randrange(7)):
            rows.append((c, t, rng.choice(["user", "system"]), rng.choice(["a", "bb", "漢字🙂"])))
    for c in range(200, 230):
        rows += [(c, t, "user", "same") for t in range(6)]
    rows += [(c, t, "user", f"long {t}") for c in (300, 350) for t in range(200 + c % 100)]
    rows += [(None, 1, "user", "x"), (400, None, None, None), (400, None, "user", None), (400, 3, "user", "last"), (-7, 0, "u", "x")]
    return rows


@pytest.mark.parametrize("local_nodes, block_turns", [(1 << 16, 1 << 12), (5, 16)])
def test_equals_dictionaries(engine, local_nodes, block_turns):
    rows = [r for r in made(random.Random(3)) if r[0] != -7 and r[:2] != (400, None)]
    turns = engine.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    placed = p.ordered_turns(turns)
    found = p.trie(p.branched(placed), local_nodes=local_nodes, block_turns=block_turns)
    assert rows_of(found) == brute(rows)
    found = p.trie(p.plain(placed), local_nodes=local_nodes, block_turns=block_turns)
    assert rows_of(found) == brute(rows, branch=False)


def test_edges(engine):
    """NULLs anywhere, repeated rows, equal turns, empty and very long texts, other columns, an empty table."""
    rows = [(None, 1, "user", "x"), (7, None, None, None), (7, None, None, None), (7, 3, "user", "last"), (8, None, "", ""),
            (8, None, "", ""), (8, 3, "user", "x" * 200_000), (9, 1, "b", "c"), (9, 1, "b", "c")]
    turns = engine.createDataFrame([(*r, 1, "u") for r in rows], "conv_id long, turn long, role string, text string, n1 int, place string")
    found = p.trie(p.plain(p.ordered_turns(turns)))
    assert rows_of(found) == brute(rows, branch=False)
    empty = p.trie(p.branched(p.ordered_turns(turns.limit(0))))
    assert empty.collect() == [] and empty.columns == found.columns


def test_one_conversation_over_many_tasks(engine):
    """Places run on from task to task."""
    turns = engine.range(3000, numPartitions=8).selectExpr(
        "5 AS conv_id", "2999 - id AS turn", "'u' AS role", "CAST(id AS string) AS text")
    placed = p.ordered_turns(turns).orderBy("place").collect()
    assert [r.place for r in placed] == list(range(1, 3001))
    assert [r.chars for r in placed] == [len(str(2999 - i)) for i in range(3000)]


def test_query_equals_its_sql(engine, sf_check):
    name = "op13_prefix_trie"
    df, sql, con = driver.queries()[name](engine, sf_check), driver.oracle_sql()[name], connect(sf_check)
    assert type_differences(df, con, sql) == []
    expected = sql_rows(con, sql)
    assert spark_rows(df) == expected and len(expected[1]) > 100
