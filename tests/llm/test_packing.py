"""Packing: every id in one piece, no window too full, and little padding."""

from __future__ import annotations

import json
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tallyward.llm import packing

PATH = P.path("word_bpe_49k.json")


def tokenizer():
    """The library as it is: an added token in a text stands for itself."""
    return Tokenizer.from_file(PATH)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=60) | st.text(alphabet="aeßµªÉσΣ' s\n\t.\xa0\x01½1", max_size=120), max_size=5))
def test_words_give_the_ids_of_the_whole_text(texts):
    found = packing.load(PATH).encode_bytes(texts)
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == [
        e.ids for e in tokenizer().encode_batch(texts, add_special_tokens=False)]


def test_added_tokens_in_a_text_are_themselves():
    texts = ["hello <|endoftext|> world", "<|startoftext|><|endoftext|>", "é<|endoftext|>'s x", "<|ENDOFTEXT|> <|endoftext", "hello world"]
    found = [np.frombuffer(f, "<u4").tolist() for f in packing.load(PATH).encode_bytes(texts)]
    assert found[0] == [3306, 49407, 1002]
    assert found == [e.ids for e in tokenizer().encode_batch(texts, add_special_tokens=False)]


def test_other_rules_are_left_to_the_library(tmp_path):
    rules = json.load(open(PATH))
    rules["normalizer"] = None
    other = tmp_path / "other.json"
    other.write_text(json.dumps(rules))
    texts = ["Hello World", "it's\tß A1"]
    coder = packing.WordTokenizer(str(other))
    assert not coder.in_words and packing.load(PATH).in_words
    assert [np.frombuffer(f, "<u4").tolist() for f in coder.encode_bytes(texts)] == [
        e.ids for e in Tokenizer.from_file(str(other)).encode_batch(texts, add_special_tokens=False)]


def plain_differencing(sizes, windows):
    """Window sums, one merge at a time over whole lists."""
    parts = sorted(([n] + [0] * (windows - 1) for n in sizes), key=lambda p: p[-1] - p[0])
    while len(parts) > 1:
        a, b = parts[0], parts[1]
        parts = parts[2:] + [sorted((x + y for x, y in zip(a, b[::-1])), reverse=True)]
        parts.sort(key=lambda p: p[-1] - p[0])
    return parts[0]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 100_000), min_size=1, max_size=40, unique=True), st.integers(1, 6))
def test_taking_many_items_at_once_changes_no_merge(sizes, windows):
    """Distinct sizes leave few ties; the spread of sums is that of plain differencing or as good."""
    found = packing.spread(np.array(sizes), windows)
    sums = sorted((sum(sizes[i] for i in items) for items in found), reverse=True)
    sums += [0] * (windows - len(sums))
    plain = plain_differencing(sizes, windows)
    assert sorted(i for items in found for i in items) == list(range(len(sizes)))
    assert sum(sums) == sum(plain)
    assert sums[0] - sums[-1] == plain[0] - plain[-1] or sums[0] <= sum(plain) / windows + max(sizes)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 2048), min_size=1, max_size=60))
def test_windows_hold_all_items_once_and_no_more_than_fits(sizes):
    sizes = np.array(sizes)
    found = packing.windows_of(sizes, 2048)
    assert sorted(i for items in found for i in items) == list(range(len(sizes)))
    assert all(sizes[items].sum() <= 2048 for items in found)


def test_differencing_levels_windows():
    sizes = np.random.default_rng(5).integers(1, 257, 4000)
    found = packing.windows_of(sizes, 2048)
    assert len(found) * 2048 - sizes.sum() < 0.005 * sizes.sum()


def test_pieces_make_up_documents_and_sequences(edge_docs, no_docs):
    rows = edge_docs.where("doc_id IS NOT NULL AND doc_id <> 4").select("doc_id", "text")
    pieces = packing.pack(rows, PATH, group_ids=5000).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
        assert p.length == len(p.ids) and p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
    for r in rows.collect():
        want = [*tokenizer().encode(r.text or "", add_special_tokens=False).ids, 1]
        own = sorted(by_doc[r.doc_id], key=lambda p: p.start)
        assert [i for p in own for i in p.ids] == want
        assert [p.start for p in own] == np.cumsum([0, *(p.length for p in own)])[:-1].tolist()
        assert {p.doc_tokens for p in own} == {len(want)}
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == np.cumsum([0, *(p.length for p in own)])[:-1].tolist()
        assert sum(p.length for p in own) <= 2048
    assert packing.pack(edge_docs, PATH).select("doc_id").where("doc_id IS NULL").count() == 1
    assert packing.pack(no_docs, PATH).count() == 0
