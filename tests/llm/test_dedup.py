"""SimHash, components and chunk deduplication against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

import __spark_entry__ as driver
from tallyward.llm import chunks, simhash
from tallyward.llm.common import table
from tallyward.llm.components import components


def classes(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


def brute_fingerprint(text, size=4):
    words = text.encode().lower().split()
    parts = [b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_components_of_all_documents(engine, sf_small):
    found = driver.queries()["op7_simhash"](engine, sf_small).collect()
    texts = {r.doc_id: r.text for r in table(engine, sf_small, "documents").collect()}
    prints = {i: brute_fingerprint(t) for i, t in texts.items()}
    assert {r.doc_id: int(r.fingerprint, 16) for r in found} == prints
    ids = sorted(prints)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if (prints[a] ^ prints[b]).bit_count() <= 4]
    assert {r.doc_id: r.component_id for r in found} == classes(ids, links)
    assert all(len(r.fingerprint) == 16 for r in found)


@pytest.mark.parametrize("tile", [3, 64])
def test_tiles_lose_no_link(engine, tile):
    rng = random.Random(tile)
    base = [rng.getrandbits(64) for _ in range(30)]
    words = list({b ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 6))) for b in base for _ in range(6)} | {0, 15, 31, 2**64 - 1})
    signed = [w - (w >> 63 << 64) for w in words]
    df = engine.createDataFrame([([w], w) for w in signed], "fp array<long>, node long")
    edges = simhash.links(df, 4, tile=tile)
    found = classes(signed, [(r.u, r.v) for r in edges.collect()])
    mask = 2**64 - 1
    want = classes(signed, [(a, b) for k, a in enumerate(signed) for b in signed[k + 1:] if ((a ^ b) & mask).bit_count() <= 4])
    assert found == want
    nodes = {r.node: r.root for r in components(edges).collect()}
    assert {n: nodes.get(n, n) for n in signed} == want


def test_copies_give_a_forest_not_all_pairs():
    rng = np.random.default_rng(1)
    near = np.uint64(12345) ^ (np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64))
    rows = np.unique(near)[:, None]
    a, b = simhash.forest(rows, None, 4, 4)
    assert len(a) == len(rows) - 1
    a, b = simhash.forest(rows, rows ^ np.uint64(1 << 7), 4, 4)
    assert len(a) == 2 * len(rows) - 1


def test_components_of_chains_stars_and_loops(engine):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 130)]
    edges = engine.createDataFrame([*chain, *star, (7, 7), (200, 201), (201, 200), (200, 201)], "u long, v long")
    found = {r.node: r.root for r in components(edges).collect()}
    assert {found[i] for i in range(41)} == {0} and {found[i] for i in range(100, 130)} == {100}
    assert found[200] == found[201] == 200 and len(found) == 41 + 30 + 2
    assert components(edges.limit(0)).count() == 0


def test_verified_links_are_as_similar_as_asked(engine):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    text = rng.choices(words, k=300)
    close, far = text.copy(), text.copy()
    close[150] = "other"
    for i in range(0, 300, 12):
        far[i] = "changed"
    rows = [(5, " ".join(text)), (3, " ".join(close)), (9, " ".join(far)), (1, " ".join(rng.choices(words, k=300)))]
    docs = engine.createDataFrame(rows, "doc_id long, text string")
    found = simhash.near_duplicates(docs, size=5, words=4, radius=120, first_radius=40, similarity=0.8)
    assert {r.doc_id: r.component_id for r in found.collect()} == {5: 3, 3: 3, 9: 9, 1: 1}


def test_a_tile_travels_by_groups_and_not_by_pairs(engine):
    rng = np.random.default_rng(6)
    prints = np.unique(rng.integers(-2**63, 2**63 - 1, (600, 4)), axis=0)
    df = engine.createDataFrame([(p.tolist(), i) for i, p in enumerate(prints)], "fp array<long>, node long")
    members, pairs, count = simhash.tiled(df, 56, 22, 8)
    tiles = simhash.packed_tiles(members.withColumn("root", members.node))
    rows = simhash.dealt(tiles, pairs.selectExpr("a", "b", "cast(null as array<struct<u:long,v:long>>) as gone"), count)
    sent = rows.where("kind = 0").groupBy("a").count().collect()
    assert sum(r["count"] for r in sent) * 4 < 2 * pairs.count() and max(r["count"] for r in sent) <= -(-count // simhash.GROUP) + simhash.LEAST_GROUPS
    largest = rows.selectExpr("max(length(nodes) + length(fps) + length(roots)) as n").first().n
    assert largest <= 48 * members.groupBy("tile").count().agg({"count": "max"}).first()[0]
    assert {(r.a, r.b) for r in rows.where("kind = 1").collect()} == {(r.a, r.b) for r in pairs.collect()}


@pytest.mark.parametrize("tile", [5, 8192])
def test_rounds_of_verified_links_against_brute_force(engine, tile):
    """Pairs on both sides of the similarity, in chains, so that refused links must give way to others."""
    rng = random.Random(tile)
    rows, n = [], 0
    for _ in range(6):
        base = rng.choices([f"w{i}" for i in range(500)], k=120)
        for _ in range(14):
            words = base.copy()
            for at in rng.sample(range(120), rng.randint(0, 5)):
                words[at] = f"x{rng.randrange(10**6)}"
            rows.append((n, " ".join(words)))
            n += 1
    sets = {i: set(simhash.shingles(t.encode().split(), 5)) for i, t in rows}
    prints = {i: simhash.hashed(list(s), 4) for i, s in sets.items()}
    near = [
        (i, j) for i in range(n) for j in range(i + 1, n) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
        and np.bitwise_count(prints[i] ^ prints[j]).sum() <= 56 and np.bitwise_count(prints[i][0] ^ prints[j][0]) <= 22]
    docs = engine.createDataFrame(rows, "doc_id long, text string")
    found = simhash.near_duplicates(docs, size=5, words=4, radius=56, first_radius=22, similarity=0.8, tile=tile)
    assert {r.doc_id: r.component_id for r in found.collect()} == classes(range(n), near)


def test_sets_of_shingles_are_those_of_the_words():
    texts = ["", "one", "one two", "A b c d e", "a b c d e f a b c d e", "b c d e f", " \n", "a b  c\td E"]
    of, hashes = simhash.shingle_sets(texts, 5)
    named = {}
    for i, text in enumerate(texts):
        parts = set(simhash.shingles(text.lower().encode().split(), 5))
        own = hashes[of == i]
        assert len(own) == len(parts) and (np.diff(own.astype(object)) > 0).all()
        assert named.setdefault(frozenset(parts), own.tobytes()) == own.tobytes()
    assert len({*named.values()}) == len(named)
    nodes = simhash.set_nodes(len(texts), of, hashes)
    assert nodes[3] == nodes[7] and nodes[0] == nodes[6] and len(set(nodes.tolist())) == len(named)


@pytest.mark.parametrize("most", [2, 5, 64])
def test_first_shingles_lose_no_link(engine, monkeypatch, most):
    """Groups that share passages, some larger than may meet at one shingle: passes and tiles come after each other."""
    rng = random.Random(most)
    words = [f"w{i}" for i in range(60)]
    common = rng.choices(words, k=40)
    rows, n = [], 0
    for size in (1, 2, 3, 7, 30):
        for _ in range(3):
            base = rng.choices(words, k=rng.choice([20, 60, 160]))
            base[:0] = common[:rng.choice([0, 10, 40])]
            for _ in range(size):
                own = base.copy()
                for at in rng.sample(range(len(own)), rng.randint(0, len(own) // 30)):
                    own[at] = rng.choice(words)
                rows.append((n, " ".join(own)))
                n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, "w1"), (n + 3, "w1"), (n + 4, "w1 w2")]
    n += 5
    sets = {i: set(simhash.shingles((t or "").encode().split(), 5)) for i, t in rows}
    prints = {i: simhash.hashed(list(s), 4) for i, s in sets.items()}
    near = [
        (i, j) for i in range(n) for j in range(i + 1, n) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
        and np.bitwise_count(prints[i] ^ prints[j]).sum() <= 56 and np.bitwise_count(prints[i][0] ^ prints[j][0]) <= 22]
    monkeypatch.setattr(simhash, "MOST_MEET", most)
    docs = engine.createDataFrame(rows, "doc_id long, text string")
    found = simhash.near_duplicates(docs, size=5, words=4, radius=56, first_radius=22, similarity=0.8)
    assert {r.doc_id: r.component_id for r in found.collect()} == classes(range(n), near)


def test_only_sets_that_meet_where_many_do_are_laid_in_tiles(engine, monkeypatch):
    """All tiles against all others is work by the square of the corpus: unrelated texts, and pairs, must not get there."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    rows = [(i, " ".join(rng.choices(words, k=120))) for i in range(150)]
    rows += [(150 + i, text + " and more") for i, text in rows[:50]]
    page = rng.choices(words, k=200)
    rows += [(200 + i, " ".join([*page, f"page{i}"])) for i in range(100)]
    monkeypatch.setattr(simhash, "MOST_MEET", 20)
    laid, tiled = [], simhash.tiled
    monkeypatch.setattr(simhash, "tiled", lambda distinct, *rest: laid.append(distinct.count()) or tiled(distinct, *rest))
    docs = engine.createDataFrame(rows, "doc_id long, text string")
    found = simhash.near_duplicates(docs, size=5, words=4, radius=56, first_radius=22, similarity=0.8)
    groups = {r.doc_id: r.component_id for r in found.collect()}
    assert groups == {**{i: i for i in range(150)}, **{150 + i: i for i in range(50)}, **dict.fromkeys(range(200, 300), 200)}
    assert sum(laid) == 100


def test_simhash_at_the_edges(edge_docs, no_docs):
    found = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(edge_docs).collect()}
    assert {(0, 0), (1, 0), (2, 0), (4, 4), (5, 4), (None, 4), (8, 7)} <= found
    assert simhash.near_duplicates(edge_docs).count() == edge_docs.count()
    assert simhash.near_duplicates(no_docs).count() == 0
    wide = simhash.near_duplicates(edge_docs, size=5, words=4, radius=56, first_radius=22, similarity=0.8)
    assert {(0, 0), (1, 0), (4, 4), (5, 4), (8, 7)} <= {(r.doc_id, r.component_id) for r in wide.collect()}


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=400) | st.text(alphabet="ab \n", max_size=4000) | st.just("q" * 5000) | st.just("漢字" * 4000))
def test_chunks_make_up_the_text_at_characters(text):
    data, ends = chunks.cut(text)
    assert data == text.encode() and (ends[-1:] == [len(data)] if data else ends == [])
    for a, b in zip([0, *ends], ends, strict=False):
        assert a < b
        data[a:b].decode()


def test_borders_resist_insertions():
    rng = random.Random(2)
    words = ["".join(rng.choice("aeioustrn") for _ in range(rng.randint(2, 8))) for _ in range(3000)]
    before, after = " ".join(words), " ".join(["some", "new", "words", *words[:1500], "inserted", *words[1500:]])
    pieces = lambda t: {t.encode()[a:b] for a, b in zip([0, *chunks.cut(t)[1]], chunks.cut(t)[1], strict=False)}
    assert len(pieces(before) - pieces(after)) <= 4


def passage(rng, n):
    return " ".join("".join(rng.choice("aeioustrnlm") for _ in range(rng.randint(3, 8))) for _ in range(n))


def test_repeated_passages_go_and_clean_documents_stay(engine):
    rng = random.Random(8)
    shared = [passage(rng, 60) for _ in range(20)]
    rows = [(i, f"{passage(rng, 30)}\n{shared[i % 20]}\n{passage(rng, 30)}") for i in range(60)]
    clean = [(i, passage(rng, 80) + " all rights reserved by the author.") for i in range(60, 120)]
    docs = engine.createDataFrame(rows + clean, "doc_id long, text string")
    found = {r.doc_id: r for r in chunks.deduplicate(docs).collect()}
    for i, text in rows + clean:
        if i < 20 or i >= 60:
            assert found[i].text == text and not found[i].removed
        else:
            middle = shared[i % 20].split()
            assert " ".join(middle[20:40]) not in found[i].text
            assert found[i].text.startswith(text.split("\n")[0][:100]) and found[i].text.endswith(text[-100:])
            data, kept = text.encode(), found[i].text.encode()
            for span in reversed(found[i].removed):
                data = data[:span.start] + data[span.end:]
            assert data == kept


def test_chunks_at_the_edges(edge_docs, no_docs):
    found = chunks.deduplicate(edge_docs).collect()
    assert len(found) == edge_docs.count()
    assert [r.text for r in found if r.doc_id == 0] == [None]
    assert {r.text for r in found if r.doc_id == 8} == {""} and {bool(r.text) for r in found if r.doc_id == 7} == {True}
    assert {r.text for r in found if r.doc_id is None} == {"one"}
    assert all(isinstance(r.removed, list) for r in found)
    other = chunks.deduplicate(edge_docs, removed="cut_spans")
    assert set(other.columns) == {*edge_docs.columns, "cut_spans"}
    assert chunks.deduplicate(no_docs).count() == 0


CHINESE = [chr(c) for c in range(0x4E00, 0x4E00 + 3000)]


def test_shared_passages_of_scripts_without_blanks_go(engine):
    rng = random.Random(3)
    text = lambda n: "".join(rng.choice(CHINESE) for _ in range(n))
    shared = text(300)
    rows = [(1, text(200) + shared + text(200)), (2, text(150) + shared + text(100)), (3, text(400)), (4, text(1000))]
    rows += [(5, rows[3][1]), (6, "สวัสดี" + text(50))]
    found = {r.doc_id: r.text for r in chunks.deduplicate(engine.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(found[i] == t for i, t in rows if i in (1, 3, 4, 6))
    assert shared[30:270] not in found[2] and len(found[2]) < 250 + 40
    assert len(found[5]) < 40


def brute_places(rows, least_words):
    """Chunk places within repeated sequences, by comparing the sequences' bytes."""
    first, spans = {}, []
    for doc, text in sorted(rows):
        data, ends = chunks.cut(text)
        starts = [0, *ends[:-1]]
        sizes = [int(chunks.words_in(data[a:b], np.array([b - a]))[0]) for a, b in zip(starts, ends)]
        found = set()
        for i in range(len(ends)):
            for j in range(i + 1, len(ends) + 1):
                # those that just reach the number of words from either end
                if sum(sizes[i:j]) >= least_words and (sum(sizes[i + 1:j]) < least_words or sum(sizes[i:j - 1]) < least_words):
                    found.add((i, j))
        for i, j in sorted(found):
            spans.append((tuple(data[a:b] for a, b in zip(starts[i:j], ends[i:j])), doc, i, j))
    for key, doc, i, j in sorted(spans, key=lambda s: s[1:]):
        first.setdefault(key, (doc, i, j))
    places = {}
    for key, doc, i, j in spans:
        kept = first[key]
        if doc != kept[0] or i >= kept[2]:
            places.setdefault(doc, set()).update(range(i, j))
    return {d: sorted(p) for d, p in places.items()}


@pytest.mark.parametrize("partitions", [2, 40])
def test_repeated_places_equal_brute_force(engine, partitions):
    """Ranges of few and of many tasks, where digests span several."""
    rng = random.Random(partitions)
    vocabulary = [passage(rng, 1) for _ in range(40)] + ["漢字", "、"]
    pieces = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(3, 14))) for _ in range(12)]
    rows = [(i, "\n".join(rng.choice(pieces) for _ in range(rng.randrange(1, 7)))) for i in range(40)]
    rows += [(100 + i, pieces[0] + " " + pieces[1]) for i in range(60)]
    docs = engine.createDataFrame(rows, "doc_id long, text string").repartition(4)
    before = engine.conf.get("spark.sql.shuffle.partitions")
    engine.conf.set("spark.sql.shuffle.partitions", partitions)
    engine.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = {r.doc_id: r.places for r in chunks.repeated_places(docs, least_words=6).collect()}
    finally:
        engine.conf.set("spark.sql.shuffle.partitions", before)
        engine.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert found == brute_places(rows, 6) and found


def test_substring_dedup_sorts_once(engine, sf_small):
    """One exchange of the sequences, and no aggregate that sorts them."""
    found = chunks.later_places(chunks.window_table(table(engine, sf_small, "documents")))
    text = found._jdf.queryExecution().toString()
    assert text.split("== Physical Plan ==")[1].count("Exchange") == 1 and "SortAggregate" not in text


@pytest.mark.parametrize("words", [8, 12, 30, 120, 300])
def test_recall_of_scattered_edits(engine, words):
    """Pairs just above the similarity, edited at scattered places or at the end: nine in ten are found."""
    rng = random.Random(words)
    vocabulary = [passage(rng, 1) for _ in range(3000)]
    rows, pairs = [], []
    for n in range(60):
        text = rng.choices(vocabulary, k=words)
        other = text.copy()
        order = rng.sample(range(words), words) if n % 2 else list(range(words - 1, -1, -1))
        for at in order:
            last = other.copy()
            last[at] = "edited" + str(n)
            if similarity(text, last) < 0.8:
                break
            other = last
        if other != text:
            rows += [(2 * n, " ".join(text)), (2 * n + 1, " ".join(other))]
            pairs.append((2 * n, 2 * n + 1))
    if not pairs:
        pytest.skip("one edit falls below the similarity")
    docs = engine.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(
        docs, size=5, words=4, radius=56, first_radius=22, similarity=0.8).collect()}
    assert sum(found[a] == found[b] for a, b in pairs) >= 0.9 * len(pairs)
    assert len(set(found.values())) >= len(pairs)


def similarity(a, b, size=5):
    one, two = ({tuple(x[i:i + size]) for i in range(max(1, len(x) - size + 1))} for x in (a, b))
    return len(one & two) / len(one | two)
