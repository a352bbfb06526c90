"""Byte-level BPE against the public encoder with the same ranks, and round trips."""

from __future__ import annotations

import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from tallyward.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def known():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80) | st.text(alphabet="aeiouthsn \n\t'.,!é漢0", max_size=200))
def test_ids_are_those_of_the_merges(text):
    coder = bpe.load(PATH, P.PATTERN)
    ranks = {t: r for r, t in coder.token.items()}
    known = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = coder.encode(text)
    assert ids == known.encode_ordinary(text)
    assert coder.decode(ids) == text.encode()


def test_pieces_that_make_it_step_back(known):
    rng = random.Random(3)
    coder = bpe.load(PATH, P.PATTERN)
    for _ in range(2000):
        piece = bytes(rng.choice(b"aetn \xc3\xa9zqth") for _ in range(rng.randint(1, 60)))
        assert coder.encode_piece(piece) == known._encode_single_piece(piece)


@pytest.mark.parametrize("text", ["a" * 100_000, "ab" * 30_000, "0" * 20_000, "   " * 5_000, "aab" * 9_000])
def test_long_pieces(known, text):
    assert bpe.load(PATH, P.PATTERN).encode(text) == known.encode_ordinary(text)


def test_rows(edge_docs, no_docs, known):
    rows = edge_docs.select("doc_id", "text").collect()
    found = bpe.round_trip(edge_docs, PATH, P.PATTERN).collect()
    want = sorted(
        (r.doc_id or -1, len(ids := known.encode_ordinary(r.text or "")),
         hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest(),
         hashlib.sha256((r.text or "").encode()).hexdigest()) for r in rows)
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found) == want
    coded = bpe.encode(edge_docs.where("doc_id IS NOT NULL"), PATH, P.PATTERN)
    texts = {bytes(r.decoded).decode() for r in bpe.decode(coded, PATH, P.PATTERN).collect()}
    assert texts == {r.text or "" for r in rows}
    assert bpe.round_trip(no_docs, PATH, P.PATTERN).count() == 0
