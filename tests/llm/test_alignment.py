"""Token alignment against a plain walk over whole texts."""

from __future__ import annotations

import hashlib
import time
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from conftest import EDGE_TEXTS
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

import __spark_entry__ as driver
from tallyward.llm import alignment

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
TOKENIZER = Tokenizer.from_file(A)
TOKENIZER.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_file=B)
LETTERS = alignment.byte_of_letter()


def spelled(text):
    """(id, begin, end) of both tokenizers over the whole text, or None."""
    if not text:
        return None
    a = [(TOKENIZER.token_to_id(t), bytes(LETTERS[c] for c in t)) for t in TOKENIZER.encode(" " + text, add_special_tokens=False).tokens]
    b = []
    for i in PIECES.encode(text):
        piece = PIECES.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if PIECES.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
        return None

    def placed(tokens):
        at, out = 0, []
        for i, x in tokens:
            out.append((i, at, at + len(x)))
            at += len(x)
        return out

    return placed(a), placed(b)


def brute(texts):
    """Rows of the contract: groups by common ends, links by overlaps, counts over all."""
    docs = []
    for text in texts:
        both = spelled(text)
        if both is None:
            docs.append((0, 0, 0, [], ""))
            continue
        a, b = both
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        sides = [[[] for _ in cuts] for _ in range(2)]
        for side, tokens in zip(sides, both):
            for i, _, y in tokens:
                side[bisect_left(cuts, y)].append(str(i))
        shown = [f"{','.join(x)}|{','.join(y)}" for x, y in zip(*sides)]
        links, j = [], 0
        for i, x, y in a:
            while b[j][2] <= x:
                j += 1
            k = j
            while k < len(b) and b[k][1] < y:
                links.append((i, b[k][0]))
                k += 1
        docs.append((len(a), len(b), len(cuts), links, ";".join(shown)))
    counts = Counter(pair for d in docs for pair in d[3])
    highest = defaultdict(int)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    return [(n_a, n_b, n_groups, len(links), sum(counts[p] == highest[p[1]] for p in links), sum(counts[p] for p in links),
             hashlib.sha256(shown.encode()).hexdigest() if shown else "") for n_a, n_b, n_groups, links, shown in docs]


def rising(size):
    return st.sets(st.integers(1, size - 1)).map(lambda s: [*sorted(s), size])


def cuts(pairs):
    """The shared ends of each text, found over all of them at once."""
    shift, a, b, last_a, last_b = 0, [], [], [], []
    for x, y in pairs:
        a += [shift + e for e in x]
        b += [shift + e for e in y]
        shift += x[-1]
        last_a.append(len(a) - 1)
        last_b.append(len(b) - 1)
    a, b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
    return a, b, a[alignment.shared_cuts(a, b, np.array(last_a, dtype=np.int64), np.array(last_b, dtype=np.int64))].tolist()


@pytest.mark.parametrize("few", [0, 8])
def test_cuts_are_the_common_ends(few, monkeypatch):
    monkeypatch.setattr(alignment, "FEW", few)

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.tuples(rising(60), rising(60)) | st.tuples(rising(700), rising(700)), max_size=5))
    def check(pairs):
        a, b, found = cuts(pairs)
        assert found == sorted(set(a.tolist()) & set(b.tolist()))
        starts_a, starts_b = np.append(0, a[:-1]), np.append(0, b[:-1])
        links = {(i, j) for i in range(len(a)) for j in np.flatnonzero((starts_a[i] < b) & (starts_b < a[i])).tolist()}
        i, j = alignment.overlaps(a, b)
        assert set(zip(i.tolist(), j.tolist())) == links and len(i) == len(links) == len(a) + len(b) - len(found)

    check()


def test_long_stretches_without_cuts_stay_cheap():
    """200,000 ends with common ones at one side only, and with none."""
    size = 200_000
    began = time.perf_counter()
    a, b = list(range(2, size, 2)), list(range(1, size, 2))
    assert len(cuts([([*a, size], [*b, size])])[2]) == 1
    shifted = [size + x for x in a], [size + x for x in b]
    assert len(cuts([([*range(1, size), *shifted[0], 2 * size], [*range(1, size), *shifted[1], 2 * size])])[2]) == size
    assert time.perf_counter() - began < 20


TEXTS = st.text(max_size=40) | st.text(alphabet="ab é▁漢\n\t '　\xa0\x1c🙂1<|>", max_size=40)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXTS, max_size=4))
def test_units_give_the_tokens_of_whole_texts(texts):
    aligner = alignment.load(A, B)
    assert aligner.in_units
    found = aligner.align(texts)
    for k, text in enumerate(texts):
        n_a, n_b, n_groups, n_links, _, _, digest = brute([text])[0]
        assert (found.n_a[k], found.n_b[k], found.n_groups[k], len(found.links[k])) == (n_a, n_b, n_groups, n_links)
        assert (hashlib.sha256(found.groups[k]).hexdigest() if found.groups[k] else "") == digest


@pytest.mark.parametrize("broadcast_pairs", [1 << 20, 0])
def test_edges(engine, edge_docs, no_docs, broadcast_pairs):
    """NULL, empty, blank, very long and repeated texts, U+2581, NULL ids, clashing columns, an empty table."""
    extra = engine.createDataFrame([(50, "a ▁ b"), (51, "<|endoftext|> </s> <0x41>")], "doc_id long, text string")
    docs = edge_docs.unionByName(extra, allowMissingColumns=True).withColumnRenamed("removed", "n_a").repartition(3)
    found = alignment.linked(docs, A, B, broadcast_pairs=broadcast_pairs)
    texts = [*EDGE_TEXTS, "one", "one", "a ▁ b", "<|endoftext|> </s> <0x41>"]
    rows = [tuple(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")) for r in found.collect()]
    assert sorted(rows) == sorted(brute(texts))
    assert alignment.linked(no_docs, A, B, broadcast_pairs=broadcast_pairs).count() == 0


def test_query_equals_a_plain_walk(engine, sf_small):
    docs = engine.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()
    found = driver.queries()["op11_token_alignment"](engine, sf_small)
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert {r.doc_id: tuple(r[c] for c in names) for r in found.collect()} == {
        d.doc_id: row for d, row in zip(docs, brute([d.text for d in docs]), strict=True)}
    assert dict(found.dtypes) == {c: "string" if c == "groups_sha256" else "bigint" for c in ("doc_id", *names)}
