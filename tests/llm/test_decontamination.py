"""Decontamination against a plain scan, in one block and in many."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from conftest import EDGE_TEXTS

import __spark_entry__ as driver
from compare import connect, spark_rows, sql_rows, type_differences
from tallyward.llm import decontamination as d

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text, items, size):
    """Number of words, places of hit words, and items, one window after another."""
    words = WORDS((text or "").translate(LOWER))
    hit, found = set(), set()
    for item, item_text in items:
        own = WORDS((item_text or "").translate(LOWER))
        k = min(size, len(own))
        for i in range(len(own) - k + 1 if own else 0):
            for j in range(len(words) - k + 1):
                if words[j:j + k] == own[i:i + k]:
                    hit.update(range(j, j + k))
                    found.add("" if item is None else str(item))
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("block_bytes", [1 << 20, 600])
def test_equals_a_plain_scan(engine, block_bytes):
    rng = random.Random(5)
    vocabulary = ["a", "B", "c7", "é", "漢字", "zz", "Q"]
    text = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([0, 1, 2, 3, 4, 5, 9, 30, 30])]
    items += [(3, "a b c7"), (None, "zz q zz"), (70, None), (8, items[8][1]), (None, "é é é é")]
    texts = [None, "", "...", *(text(rng.randrange(60)) for _ in range(60)), items[7][1], "zz q zz", "x", items[8][1] + " \x01A"]
    docs = engine.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    found = d.find(docs, engine.createDataFrame(items, "item_id long, text string"), size=4, block_bytes=block_bytes)
    rows = {r.doc_id: r for r in found.collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        n_words, n_hit, ids = brute(t, items, 4)
        assert (rows[i].n_words, rows[i].n_hit, rows[i].item_ids) == (n_words, n_hit, ids)
        data = (t or "").encode()
        inside = [w for s in rows[i].spans for w in WORDS(data[s.start:s.end].decode().translate(LOWER))]
        assert len(inside) == n_hit


def test_spans_go_or_documents_go(engine):
    items = engine.createDataFrame([(1, "One two, three four.")], "item_id long, text string")
    docs = engine.createDataFrame(
        [(1, "é one TWO three - four end"), (2, "one two three"), (3, None)], "doc_id long, text string")
    found = d.find(docs, items)
    assert {r.doc_id: r.text for r in d.without_spans(found).collect()} == {1: "é  end", 2: "one two three", 3: None}
    assert {r.doc_id for r in d.without_documents(found).collect()} == {2, 3}
    assert d.without_documents(found, 0.9).count() == 3


@pytest.mark.parametrize("block_bytes", [1 << 25, 2000])
def test_edges(engine, edge_docs, no_docs, block_bytes):
    """NULL, empty, blank, very long and repeated texts, NULL ids, clashing columns, empty tables."""
    items = engine.createDataFrame([(1, "the dog sat on the log all rights"), (2, "word " * 50), (3, "漢" * 5000), (4, "ONE")],
                                   "item_id long, text string")
    clash = edge_docs.withColumnsRenamed({"source": "n_hit", "removed": "Spans"})
    found = d.find(clash, items, block_bytes=block_bytes)
    assert [c.lower() for c in found.columns].count("spans") == 1 and [c.lower() for c in found.columns].count("n_hit") == 1
    rows = found.collect()
    assert len(rows) == edge_docs.count()
    known = [(1, "the dog sat on the log all rights"), (2, "word " * 10), (3, "漢" * 5000), (4, "ONE")]
    for r in rows:
        if r.text and len(r.text) == 150_000:
            assert (r.n_words, r.n_hit, r.item_ids) == (30_000, 30_000, ["2"])
        elif r.text is None or r.text in EDGE_TEXTS:
            assert (r.n_words, r.n_hit, r.item_ids) == brute(r.text, known, 10)
    assert d.find(no_docs, items, block_bytes=block_bytes).count() == 0
    none = d.find(edge_docs, items.limit(0), block_bytes=block_bytes).collect()
    assert len(none) == len(rows) and not any(r.n_hit or r.item_ids or r.spans for r in none)


def test_query_equals_its_sql(engine, sf_small):
    name = "op12_decontamination"
    df, sql, con = driver.queries()[name](engine, sf_small), driver.oracle_sql()[name], connect(sf_small)
    assert type_differences(df, con, sql) == []
    expected = sql_rows(con, sql)
    assert spark_rows(df) == expected
    none = hashlib.sha256(b"").hexdigest()
    assert {r.contaminated for r in df.collect()} == {True, False} and none in {r.items_sha256 for r in df.collect()}
