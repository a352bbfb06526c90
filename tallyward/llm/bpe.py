"""Byte-level BPE by backtracking from longest matches, and decoding.

Bytes are written as Latin-1 characters, so that an Aho-Corasick trie over text
finds the longest token at a place. Encoding takes longest matches and steps back
when two neighbours could not both have survived the merges; whether they can is
decided by undoing their merges and is remembered by pair. A place found to be a
dead end is never entered again, so the work is linear in the text. The ids are
those of the merges themselves.

Defined results: NULL is read as the empty text, which has no ids. Repeated rows
get repeated results; other columns are not touched.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
import struct
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import blocks

MEMO_PAIRS = 300_000
MEMO_PIECES = 250_000
GPT2_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
"""Fixed value: the public pattern for which texts may be split at single spaces."""
# white space beside a space, or a space at the end
RUN_WITH_SPACE = re.compile(r" \s|\s | $").search


class ByteBPE:
    """Encoder and decoder of a rank file; single bytes must come first in it."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.token = {rank: token for token, rank in ranks.items()}
        self.bytes_of = [self.token.get(i, b"") for i in range(max(self.token, default=-1) + 1)]
        self.split_text = regex.compile(pattern).findall
        self.trie = ahocorasick.Automaton()
        self.rank = {}
        for token, rank in ranks.items():
            self.trie.add_word(token.decode("latin-1"), rank)
            self.rank[token.decode("latin-1")] = rank
        self.longest = max(map(len, ranks), default=1)
        self.text_of = [t.decode("latin-1") for t in self.bytes_of]
        self.sizes = [len(t) for t in self.bytes_of]
        self.fits: dict[int, bool] = {}
        self.merge: dict[tuple[int, int], int] = {}
        self.halves: list[tuple[int, int]] = [(i, i) for i in range(len(self.bytes_of))]
        self.shorter: list[int] = [-1] * len(self.bytes_of)
        for rank in sorted(self.token):
            word = self.text_of[rank]
            for cut in range(len(word) - 1, 0, -1):
                left = self.rank.get(word[:cut])
                if left is None:
                    continue
                if self.shorter[rank] < 0:
                    self.shorter[rank] = left
                right = self.rank.get(word[cut:])
                if left < rank and right is not None and right < rank and self._survive(left, right):
                    self.merge[left, right] = rank
                    self.halves[rank] = (left, right)
                    break
        self.pieces: dict[str, bytes] = {}
        self.units: dict[str, bytes] = {}
        self.space_begins_match = pattern == GPT2_PATTERN

    def _survive(self, left: int, right: int) -> bool:
        """Whether merging both texts side by side leaves exactly these two tokens.

        Undoes the later of the two merges, again and again: had a merge across
        the border come before the one just undone, it would have won.
        """
        before = len(self.bytes_of)
        while True:
            across = self.merge.get((left, right))
            if across is not None and across < before:
                return False
            # the merge made last is undone first; of equal ranks the right one was made last
            for side in ("left", "right") if left > right else ("right", "left"):
                if side == "left" and self.halves[left][1] != left:
                    before, left = left, self.halves[left][1]
                    break
                if side == "right" and self.halves[right][0] != right:
                    before, right = right + 1, self.halves[right][0]
                    break
            else:
                return True

    def _compatible(self, left: int, right: int) -> bool:
        if len(self.fits) >= MEMO_PAIRS:
            self.fits.clear()
        known = self.fits[left << 32 | right] = self._survive(left, right)
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        text = piece.decode("latin-1")
        rank, fits, sizes, shorter = self.rank, self.fits, self.sizes, self.shorter
        whole = rank.get(text)
        if whole is not None:
            return [whole]
        size, longest, longest_prefix = len(text), self.longest, self.trie.longest_prefix
        dead = bytearray(size + 1)
        ids: list[int] = []
        at, last, candidate = 0, -1, -1
        while at < size:
            if candidate < 0:
                window = text[at:at + longest]
                reach = longest_prefix(window)
                candidate = rank.get(window[:reach])
                while candidate is None:  # the trie's path goes on beyond the longest token
                    reach -= 1
                    candidate = rank.get(window[:reach])
            while candidate >= 0:
                end = at + sizes[candidate]
                if not dead[end]:
                    if last < 0:
                        break
                    fit = fits.get(last << 32 | candidate)
                    if fit or fit is None and self._compatible(last, candidate):
                        break
                candidate = shorter[candidate]
            if candidate >= 0:
                ids.append(candidate)
                at, last, candidate = end, candidate, -1
            else:  # nothing can follow here: shorten the token before
                dead[at] = 1
                candidate = ids.pop()
                at -= sizes[candidate]
                last = ids[-1] if ids else -1
        return ids

    def _packed(self, piece: str) -> bytes:
        ids = self.encode_piece(piece.encode("utf-8", "surrogatepass"))
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(self.pieces) >= MEMO_PIECES:
            self.pieces.clear()
        if len(piece) <= 64:
            self.pieces[piece] = packed
        return packed

    def _pieces(self, text: str) -> bytes:
        known = self.pieces.get
        return b"".join([known(p) or self._packed(p) for p in self.split_text(text)])

    def _unit(self, unit: str) -> bytes:
        packed = self._pieces(unit)
        if len(self.units) >= MEMO_PIECES:
            self.units.clear()
        if len(unit) <= 64:
            self.units[unit] = packed
        return packed

    def encode_bytes(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers.

        A match never goes on past a single space between other characters but
        begins with it, so such texts are split there first: a cheaper split, whose
        parts are remembered as well.
        """
        if not self.space_begins_match or RUN_WITH_SPACE(text):
            return self._pieces(text)
        first, *rest = text.split(" ")
        known = self.units.get
        units = [" " + w for w in rest]
        return self._pieces(first) + b"".join([known(u) or self._unit(u) for u in units])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), dtype="<u4").tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@functools.cache
def load(path: str, pattern: str) -> ByteBPE:
    """The coder of a rank file, built once in a process."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    return ByteBPE(ranks, pattern)


def encode(docs: DataFrame, path: str, pattern: str, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key`` and ids (array of int) of each whole text; the rank file lies on every machine."""
    return _coded(docs, path, pattern, text, key, digest=False)


def decode(ids: DataFrame, path: str, pattern: str, *, column: str = "ids", key: str = "doc_id") -> DataFrame:
    """``key`` and the decoded bytes of each row's ids; NULL ids give no bytes."""
    source = ids.select(F.col(key).alias("key"), F.col(column).cast("array<int>").alias("ids"))
    kind = source.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = load(path, pattern)
        for batch in batches:
            out = [coder.decode(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(out, pa.binary())], names=["key", "decoded"])

    return source.mapInArrow(run, f"key {kind}, decoded binary").withColumnRenamed("key", key)


def round_trip(docs: DataFrame, path: str, pattern: str, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, n_tokens, and digests of the ids and of the bytes they decode to.

    One pass: what only digests are wanted of is never sent between processes.
    """
    return _coded(docs, path, pattern, text, key, digest=True)


def _coded(docs: DataFrame, path: str, pattern: str, text: str, key: str, *, digest: bool) -> DataFrame:
    source = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    columns = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = load(path, pattern)
        for batch, texts in blocks(batches):
            packed = [coder.encode_bytes(t) for t in texts]
            if digest:
                decoded = [coder.decode(np.frombuffer(p, dtype="<u4").tolist()) for p in packed]
                arrays = [
                    pa.array([len(p) // 4 for p in packed], pa.int64()),
                    pa.array([hashlib.sha256(p).hexdigest() for p in packed]),
                    pa.array([hashlib.sha256(d).hexdigest() for d in decoded]),
                ]
                names = ["n_tokens", "ids_sha256", "decoded_sha256"]
            else:
                values = np.frombuffer(b"".join(packed), dtype="<u4").astype(np.int32)
                offsets = list(chain([0], np.cumsum([len(p) // 4 for p in packed]).tolist()))
                arrays = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))]
                names = ["ids"]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *arrays], names=["key", *names])

    return source.mapInArrow(run, f"key {kind}, {columns}").withColumnRenamed("key", key)
