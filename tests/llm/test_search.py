"""Top-k search, n-gram scores, notices and fingerprints against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

import __spark_entry__ as driver
from tallyward.llm import lm, notices, rarity, topk
from tallyward.llm.common import table
from tallyward.llm.eliasfano import EliasFano, NgramTrie


def brute_top(vectors, queries, k):
    rows = []
    for q in queries:
        found = sorted((-int(np.dot(q[1], v[1])), v[0]) for v in vectors if v[0] != q[0])[:k]
        rows += [(q[0], i + 1, c, -s) for i, (s, c) in enumerate(found)]
    return sorted(rows)


def test_top_k_equals_sql(engine, sf_check):
    found = driver.queries()["op1_topk_search"](engine, sf_check).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_check}/embeddings.parquet'")
    want = con.execute(driver.oracle_sql()["op1_topk_search"]).fetchall()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found) == sorted(want)


@pytest.mark.parametrize("block", [7, 8192])
def test_top_k_with_ties_copies_and_many_blocks(engine, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    rng = np.random.default_rng(block)
    rows = [(i, rng.integers(-3, 4, 5).tolist()) for i in range(150)] + [(i, [2, -1, 0, 3, 1]) for i in range(150, 200)]
    df = engine.createDataFrame(rows, "vec_id long, v array<long>")
    found = topk.search(df.where("vec_id % 10 = 0"), df, 6)
    assert sorted(map(tuple, found.collect())) == brute_top(rows, [r for r in rows if r[0] % 10 == 0], 6)


def test_top_k_at_the_edges(engine):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]),
            (5, [0.5]), (6, []), (None, [1.0, 1.0]), (0, [1.0, 2.0]), (20, [-1.0, 0.25])]
    df = engine.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS v", "2 AS score")
    vectors = topk.integral(df, key="vec_id", vector="embedding", scale=64)
    found = topk.search(vectors.where("vec_id % 20 = 0"), vectors, 20)
    whole = [(0, [64, 128]), (5, [32, 0]), (6, [0, 0]), (20, [-64, 16])]
    assert sorted(map(tuple, found.collect())) == brute_top(whole, [whole[0], whole[3]], 20)
    assert topk.search(vectors.limit(0), vectors.limit(0), 3).count() == 0
    large = engine.createDataFrame([(i, [(1 << 30) + i, -(1 << 29)]) for i in range(5)], "vec_id long, v array<long>")
    assert topk.search(large.where("vec_id = 0"), large, 1).first().score == (1 << 30) * ((1 << 30) + 4) + (1 << 58)


@pytest.mark.parametrize("size", [4e7, 6e7, 1e8, 1e12, 1e17, 1e300])
def test_large_components_end_no_query(engine, size):
    """Exact scores while they fit a long, and the nearest long beyond."""
    rng = random.Random(7)
    rows = [(i, [rng.choice([-1, 1]) * size * rng.random(), rng.random(), rng.uniform(-9, 9)]) for i in range(60)]
    df = engine.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = topk.integral(df, key="vec_id", vector="embedding", scale=64)
    of = {r.vec_id: r.v for r in vectors.collect()}
    found = topk.search(vectors.where("vec_id % 20 = 0"), vectors, 5).collect()
    most = (1 << 63) - 1
    for q in (0, 20, 40):
        exact = {i: max(-most, min(most, sum(a * b for a, b in zip(of[q], v)))) for i, v in of.items() if i != q}
        want = sorted(exact.items(), key=lambda x: (-x[1], x[0]))[:5]
        assert [(r.vec_id, r.score) for r in sorted((r for r in found if r.query_id == q), key=lambda r: r["rank"])] == want


def test_vectors_go_to_the_query_blocks_that_visit_them(engine, monkeypatch):
    """Fewer rows meet the queries than vectors times blocks of queries."""
    monkeypatch.setattr(topk, "BLOCK", 64)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(8, 6)) * 40
    rows = [(i, (centres[i % 8] + rng.normal(size=6)).tolist()) for i in range(1600)]
    df = engine.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = topk.integral(df, key="vec_id", vector="embedding", scale=64)
    copied = []
    original = topk.stage

    def recorded(staged, name):
        result = original(staged, name)
        if name == "topk-visits":
            copied.append(result.select("cell", "part", "qpart").distinct().count())
        return result

    monkeypatch.setattr(topk, "stage", recorded)
    assert topk.search(vectors.where("vec_id % 4 = 0"), vectors, 5).count() == 2000
    blocks = -(-400 // 64)
    assert len(copied) == 2 and sum(copied) * 64 < 2 * 1600 * blocks


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 1 << 40), min_size=1, max_size=200), st.lists(st.integers(0, 1 << 41), min_size=1, max_size=30))
def test_elias_fano(values, asked):
    values = np.sort(np.array(values))
    code = EliasFano.build(values)
    assert code.access(np.arange(len(values))).tolist() == values.tolist()
    asked = np.array(asked)
    zero, size = np.zeros(len(asked), dtype=np.int64), np.full(len(asked), len(values))
    assert code.successor(asked, zero, size).tolist() == np.searchsorted(values, asked).tolist()


def tokens(text):
    return [*(text or "").encode().lower().split(), b" "]


def test_scores_of_all_documents(engine, sf_small):
    found = driver.queries()["op4_ngram_lm"](engine, sf_small).collect()
    texts = {r.doc_id: r.text for r in table(engine, sf_small, "documents").collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    counts = Counter(t for i, x in texts.items() if not held[i] for t in tokens(x))
    total, distinct = sum(counts.values()), len(counts)
    assert len(found) == len(texts)
    for r in found:
        own = tokens(texts[r.doc_id])
        base = sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in own)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(own), sum(counts[t] > 0 for t in own), total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
    unseen = [r for r in found if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_probabilities_after_a_context_sum_to_one(engine):
    rng = random.Random(6)
    docs = engine.createDataFrame([(i, " ".join(rng.choices("abcdefg", weights=[9, 7, 5, 3, 2, 1, 1], k=30))) for i in range(60)], "doc_id long, text string")
    model = lm.fit(docs, vocabulary_share=0.0, ngram_share=2e-3)
    trie = NgramTrie.mapped(model.trie)
    words = len(model.vocabulary)
    free = 1 - (10**model.unigram_logs).sum()
    for a in range(words):
        ids = np.array([[a, b] for b in range(words)]).reshape(-1)
        doc = np.repeat(np.arange(words), 2)
        gain = lm.gains(trie, ids, doc, model.unigram_logs)[1::2]
        back = 10**float(trie.back_off(1, np.array([a]))[0])
        assert abs((10**(model.unigram_logs + gain)).sum() + free * back - 1) < 0.05
        for b in range(words):
            if trie.bigram(np.array([a]), np.array([b]))[0] < 0:
                continue
            ids = np.array([[a, b, c] for c in range(words)]).reshape(-1)
            gain = lm.gains(trie, ids, np.repeat(np.arange(words), 3), model.unigram_logs)[2::3]
            assert abs((10**(model.unigram_logs + gain)).sum() - 1) < 0.1


def test_language_model_at_the_edges(edge_docs, no_docs):
    model = lm.fit(edge_docs)
    found = lm.score(edge_docs, model).collect()
    assert len(found) == edge_docs.count() and all(r.score <= 0 and math.isfinite(r.score) for r in found)
    assert {r.n_tokens for r in found if r.doc_id in (0, 1, 2)} == {1}
    assert lm.score(no_docs, model).count() == 0
    nothing = lm.score(edge_docs, lm.fit(no_docs)).collect()
    assert {r.n_known for r in nothing} == {0} and len(nothing) == edge_docs.count()


def brute_places(text):
    words = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())
    found = []
    for phrase, label in notices.BASE_PHRASES.items():
        parts = phrase.encode().split()
        found += [(i, label) for i in range(len(words) - len(parts) + 1) if words[i:i + len(parts)] == parts]
    return len(words), sorted(found)


def test_base_phrases_of_all_documents(engine, sf_small, edge_docs, no_docs):
    docs = table(engine, sf_small, "documents").select("doc_id", "text").union(edge_docs.select("doc_id", "text"))
    texts = Counter((r.text, *brute_places(r.text)[:1], str(brute_places(r.text)[1])) for r in docs.collect())
    found = notices.scan(docs).collect()
    assert Counter(n for _, n, _ in texts.elements()) == Counter(r.n_words for r in found)
    for r in found:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.n_base == 0) == (r.first_word is None)
    of = {r.doc_id: r for r in notices.scan(table(engine, sf_small, "documents")).collect()}
    for d in table(engine, sf_small, "documents").collect():
        n, places = brute_places(d.text)
        r = of[d.doc_id]
        assert (r.n_words, r.n_base) == (n, len(places))
        assert (r.first_word, r.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({p[1] for p in places}))
    assert notices.scan(no_docs).count() == 0


def apart(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_long_texts_of_notices_are_scanned_in_proportion():
    finder = notices.NoticeFinder()
    block = " ".join(notices.NOTICES) + " words between them and all rights resrved "
    seconds = []
    for copies in (500, 1000, 2000):
        joined = " " + block * copies
        began = time.perf_counter()
        places, starts = finder.base(joined)
        found = finder.fuzzy(joined)
        seconds.append(time.perf_counter() - began)
        assert len(starts) == copies * sum(" ".join(["", *block.split(), ""]).count(f" {p} ") for p in notices.BASE_PHRASES)
        assert starts == sorted(starts) and len({m.first_word for m in found}) >= copies * 12
        words = joined.split()
        for label, first, count in places[:: max(1, len(places) // 50)]:
            assert notices.BASE_PHRASES[" ".join(words[first:first + count])] == label
        for m in found[:: max(1, len(found) // 50)]:
            assert m.errors <= notices.MOST_ERRORS and m.words == len(words[m.first_word:m.first_word + m.words])
    assert seconds[-1] < 8 * max(seconds[0], 0.2)


def test_places_of_notices_equal_a_plain_scan():
    """Exact phrases by splitting words; fuzzy ones by matching at every word."""
    rng = random.Random(12)
    finder = notices.NoticeFinder()
    phrases = list(notices.NOTICES)
    for _ in range(40):
        words = []
        for _ in range(rng.randrange(1, 12)):
            words += [rng.choice(["cc", "by", "general", "x", "license"])] if rng.random() < 0.5 else rng.choice(phrases).split()
        joined = f" {' '.join(words)} "
        expected = sorted((i, label) for i in range(len(words)) for p, label in notices.BASE_PHRASES.items() if words[i:i + len(p.split())] == p.split())
        places, _ = finder.base(joined)
        assert sorted((first, label) for label, first, _ in places) == expected
        exact = {(i, label) for i in range(len(words)) for p, label in notices.NOTICES.items() if words[i:i + len(p.split())] == p.split()}
        assert {(m.first_word, m.label) for m in finder.fuzzy(joined) if m.errors == 0} == exact


def test_notices_from_a_table(engine):
    rows = [("Do What, You want", "wtfpl"), ("do what you want", "later"), (None, "x"), ("...", "y"), ("some licence text here", None)]
    finder = notices.finder_of(engine.createDataFrame(rows, "phrase string, label string"))
    docs = engine.createDataFrame([(1, "You may DO what you want!"), (2, "some licence text here")], "doc_id long, text string")
    assert {r.doc_id: r.labels for r in notices.scan(docs, finder=finder).collect()} == {1: "later", 2: ""}
    with pytest.raises(ValueError, match="more than 2"):
        notices.finder_of(engine.createDataFrame(rows, "phrase string, label string"), most=2)


def test_notices_with_errors():
    rng = random.Random(11)
    finder = notices.NoticeFinder()
    for phrase, label, errors, _ in finder.notices:
        for _ in range(20):
            changed = list(phrase)
            for _ in range(rng.randint(0, errors)):
                at = rng.randrange(1, len(changed) - 1)
                changed[at:at + 1] = rng.choice([[], ["x"], [changed[at], "q"]])
            text = "".join(changed)
            if "  " in text or text != text.strip():
                continue
            found = finder.fuzzy(f" some words before {text} and after ")
            hits = [m for m in found if m.label == label]
            assert hits and min(m.errors for m in hits) <= apart(phrase, text), (phrase, text)
    assert finder.fuzzy(" nothing of that kind stands here at all ") == []


def test_edited_texts_and_neighbours(engine, sf_small):
    found = {r.doc_id: r for r in driver.queries()["op10_fingerprint"](engine, sf_small).collect()}
    texts = {r.doc_id: r.text or "" for r in table(engine, sf_small, "documents").collect()}
    ids = sorted(texts, reverse=True)
    of = {i: rarity.Fingerprint.of(t.encode()) for i, t in texts.items()}
    assert sorted(found) == sorted(ids)
    for i, following in zip(ids, [*ids[1:], ids[0]], strict=True):
        text, r = texts[i], found[i]
        third = len(text) // 3
        changed = (text[:len(text) - third] + texts[following][:third]).encode()
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed).hexdigest())
        assert r.fingerprint == of[i].text() and r.edited_fingerprint == rarity.Fingerprint.of(changed).text()
        assert r.near_next == of[i].likeness(of[following]) and 0 <= r.near_next <= 1
    assert np.mean([r.near_edited for r in found.values()]) > np.mean([r.near_next for r in found.values()]) + 0.4


def test_ranges_do_not_change_neighbours(engine, edge_docs, no_docs):
    one = rarity.with_next(edge_docs).collect()
    many = rarity.with_next(edge_docs, rows_per_range=2).collect()
    assert len(one) == len(many) == edge_docs.count()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.edited_sha256, r.near_next)
    assert sorted(map(key, one)) == sorted(map(key, many))
    assert rarity.with_next(no_docs).count() == 0
    lone = rarity.with_next(edge_docs.where("doc_id = 7")).first()
    assert lone.near_next == 1.0
    assert rarity.fingerprints(edge_docs).count() == edge_docs.count()


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=300))
def test_window_sums_are_those_of_the_counts(data):
    found = rarity.window_sums(np.frombuffer(data, dtype=np.uint8))
    want = [sum(int(rarity._TERMS[c]) for c in Counter(data[i:i + 32]).values()) for i in range(max(0, len(data) - 31))]
    assert found.tolist() == want
    own = rarity.Fingerprint.of(data)
    assert own.likeness(own) == 1.0 and rarity.Fingerprint.parse(own.text()).likeness(own) == 1.0
