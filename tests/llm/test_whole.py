"""Whole jobs where parts once did: rare n-grams, refused links, scattered chunks, repeated insults."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest

from tallyward.llm import chunks, lm, simhash, toxicity


def words_of(text):
    return [*text.split(), " "]


def brute_scores(train, texts):
    """Back-off scores with all n-grams."""
    one, two, three = Counter(), Counter(), Counter()
    for text in train:
        w = words_of(text)
        one.update(w)
        two.update(zip(w, w[1:]))
        three.update(zip(w, w[1:], w[2:]))
    size = one.total() + len(one) + 1
    after1, after2 = defaultdict(list), defaultdict(list)
    for a, b in two:
        after1[a].append(b)
    for a, b, c in three:
        after2[a, b].append(c)
    p1 = lambda c: (one[c] + 1) / size
    p2 = lambda b, c: (two[b, c] - lm.DISCOUNT) / one[b]
    p3 = lambda a, b, c: (three[a, b, c] - lm.DISCOUNT) / two[a, b]

    def given_one(b, c):
        if (b, c) in two:
            return p2(b, c)
        seen = after1[b] if b in after1 else []
        return p1(c) * (1 - sum(p2(b, x) for x in seen)) / (1 - sum(map(p1, seen)))

    def given_two(a, b, c):
        if (a, b, c) in three:
            return p3(a, b, c)
        seen = after2[a, b] if (a, b) in after2 else []
        return given_one(b, c) * (1 - sum(p3(a, b, x) for x in seen)) / (1 - sum(p2(b, x) for x in seen))

    found = []
    for text in texts:
        w = words_of(text)
        found.append(sum(math.log10(
            given_two(*w[i - 2:i + 1]) if i > 1 else given_one(*w[:2]) if i else p1(w[0])) for i in range(len(w))))
    return found


@pytest.mark.parametrize("shard", [2000, 1 << 20])
def test_rare_words_and_n_grams_count(engine, monkeypatch, shard):
    """Every n-gram counts, however rare, and in whichever shard it lies."""
    monkeypatch.setattr(lm, "SHARD_TOKENS", shard, raising=False)
    rng = random.Random(shard)
    names = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    train = [" ".join(rng.choices(names, weights, k=rng.randint(1, 60))) for _ in range(150)]
    train.append("filler " * 30_000)
    texts = train[:40] + [" ".join(rng.choices([*names, "unseen"], [*weights, 0.2], k=rng.randint(1, 60))) for _ in range(40)]
    schema = "doc_id long, text string"
    # words below 20 are joined from storage
    model = lm.fit(engine.createDataFrame(list(enumerate(train)), schema), common_share=20 / 35_000)
    found = {r.doc_id: r for r in lm.score(engine.createDataFrame(list(enumerate(texts)), schema), model).collect()}
    wrong = [found[i].score - want for i, want in enumerate(brute_scores(train, texts))]
    # values have codes of eight bits, so that single ones are a little off
    assert max(abs(x) / found[i].n_tokens for i, x in enumerate(wrong)) < 0.1
    assert abs(sum(wrong)) < 0.02 * sum(r.n_tokens for r in found.values()), sum(wrong)


def jaccard(a, b, size=5):
    x, y = ({tuple(t.split()[i:i + size]) for i in range(len(t.split()) - size + 1)} for t in (a, b))
    return len(x & y) / len(x | y)


def test_refused_links_hide_no_others(engine):
    """Variants of templates: all links that are similar enough join, whatever the false ones between them."""
    rng = random.Random(3)
    rows = []
    for _ in range(2):
        base = [f"w{rng.randrange(5000)}" for _ in range(200)]
        for _ in range(30):
            words = base.copy()
            for at in rng.sample(range(200), 3):
                words[at] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(words)))
    docs = engine.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(
        docs, size=5, words=4, radius=56, first_radius=22, similarity=0.8).collect()}
    root = list(range(len(rows)))
    for j in range(len(rows)):
        for i in range(j):
            near = [simhash.fingerprint(" ".join(rows[k][1].split()), 5, 4) for k in (i, j)] if i // 30 == j // 30 else None
            if near is None or jaccard(rows[i][1], rows[j][1]) < 0.8:
                continue
            apart = [(int(x) ^ int(y)).bit_count() for x, y in zip(*near)]
            if sum(apart) <= 56 and apart[0] <= 22:
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    assert len(set(root)) < len(rows) and found == dict(enumerate(root))


def test_sets_decide_not_repeated_shingles(engine):
    rng = random.Random(5)
    body = [" ".join(f"w{rng.randrange(5000)}" for _ in range(200)) for _ in range(3)]
    footer = " all the news from our town"
    rows = [(0, body[0] + " filler" * 260), (1, body[1] + " filler" * 260), (2, body[2] + footer), (3, body[2] + footer * 60)]
    docs = engine.createDataFrame(rows, "doc_id long, text string")
    found = simhash.near_duplicates(docs, size=5, words=4, radius=56, first_radius=22, similarity=0.8)
    assert {r.doc_id: r.component_id for r in found.collect()} == {0: 0, 1: 1, 2: 2, 3: 2}


def test_chunks_that_repeat_one_by_one_stay(engine):
    """A text of common pieces from many documents repeats nowhere; a passage does."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("aeioustrnlm") for _ in range(6))
    common, ends = [], chunks.cut(" ".join(word() for _ in range(400)))
    for a, b in zip([0, *ends[1]], ends[1][:-1], strict=False):
        common.append(ends[0][a:b].decode())
    rows = [(i, " ".join(rng.choices(common, k=60)).replace("  ", " ")) for i in range(40)]
    passage = " ".join(word() for _ in range(60))
    rows += [(100, passage + " " + word()), (101, word() + " " + passage)]
    found = {r.doc_id: r for r in chunks.deduplicate(engine.createDataFrame(rows, "doc_id long, text string")).collect()}
    texts = {i: t.split() for i, t in rows}
    grams = lambda i: {tuple(texts[i][k:k + 10]) for k in range(len(texts[i]) - 9)}
    for i, text in rows[:40]:
        others = set().union(*(grams(j) for j, _ in rows if j != i))
        if not grams(i) & others:
            assert found[i].text == text
    assert found[100].text == rows[-2][1] and len(found[101].text) < 60 + len(rows[-1][1]) - 6 * 40


def test_a_repeated_insult_is_found_each_time():
    words = dict.fromkeys(["grumble", "scoundrel", "villain", "wretch"], 3.0)
    model = toxicity.ToxicityModel(words, 1.0, 1.0, 0.0)
    clean, insult = ["fine"] * 400, list(words)
    spans = lambda t: [f[:2] for f in model.passages(" ".join(t))[1]]
    assert spans([*clean, *insult, *clean, *insult, *clean]) == [(400, 404), (804, 808)]
    # scattered words, each below what a text of that length shows, do not hide the passage after them
    scattered = [w for x in insult for w in [x, *clean]]
    assert spans([*scattered, *insult]) == [(len(scattered), len(scattered) + 4)]
    # within a segment, repetition adds nothing
    once, often = (model.passages(" ".join(t))[1] for t in ([*insult, *clean], [*insult * 3, *clean[8:]]))
    assert len(once) == len(often) == 1 and abs(once[0][2] - often[0][2]) < 1e-9
    assert spans([*["villain"] * 50, *clean]) == []
