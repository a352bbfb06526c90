"""Packing documents into training windows by multiway differencing.

A document's ids are cut into whole windows and a rest, and the rest into pieces
of ``piece_ids``: differencing needs several items in each window to level them
(whole rests left 4 % of padding, pieces of 1024, 512 and 256 ids 1.0, 0.8 and
0.2 %). The pieces of a group are spread over windows by Karmarkar-Karp differencing: every piece begins as a
partition of its own; the two partitions with the largest imbalance are merged,
fullest window against emptiest, until one is left, whose windows are nearly
equal. If the fullest exceeds the capacity, the window count rises by one and the
group is spread anew.

A group is what a task has gathered when it holds ``group_ids`` ids, or its last
rows: memory is bounded and no group depends on another. Sequence ids are unique
and follow from the partition and the group, so a lost task repeats them.

Defined results: NULL is read as the empty text, whose only id is the end id.
Repeated rows are packed once each. A NULL key stays NULL.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyward.llm.common import blocks, record_batch

CAPACITY = 2048
MEMO_WORDS = 250_000
GROUPS_BITS = 40
"""Low bits of a sequence id that count sequences within a partition."""
BETWEEN_WORDS = re.compile(r"[ \t\n\r]+").split
LATIN = re.compile(r"[\x00-\xff]*\Z").match
LETTERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff"
PARTS = re.compile(rf"[^ \t\n\r']*'[^ \t\n\r]*|[{LETTERS}]+|[^ \t\n\r{LETTERS}]+").findall
MARK = "\x01"
WORDS_PER_CALL = 200


KNOWN_RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
    "post_processor": None,
}
"""Fixed values: the public rules for which texts may be split into words."""


def _united(sums: np.ndarray, roots: np.ndarray, other: np.ndarray, theirs: np.ndarray, windows: int,
            trees: list[tuple[int, int]], count: int) -> tuple[np.ndarray, np.ndarray]:
    """Two partitions as one: fullest windows against emptiest, side by side where windows are left."""
    if len(sums) < len(other):
        sums, roots, other, theirs = other, theirs, sums, roots
    meet = max(0, len(sums) + len(other) - windows)
    total, joined = sums.copy(), roots.copy()
    if meet:
        total[-meet:] += other[:meet][::-1]
        new = np.arange(count + len(trees), count + len(trees) + meet)
        trees.extend(zip(roots[-meet:].tolist(), theirs[:meet][::-1].tolist(), strict=True))
        joined[-meet:] = new
    if meet == 1 and len(other) == 1:  # one window has grown: it moves up
        value, root = total[-1], joined[-1]
        at = int(np.searchsorted(-total[:-1], -value, side="right"))
        total[at + 1:], joined[at + 1:] = total[at:-1].copy(), joined[at:-1].copy()
        total[at], joined[at] = value, root
        return total, joined
    total, joined = np.concatenate([total, other[meet:]]), np.concatenate([joined, theirs[meet:]])
    order = np.argsort(-total, kind="stable")
    return total[order], joined[order]


def spread(sizes: np.ndarray, windows: int) -> list[list[int]]:
    """Item numbers by window, by largest differencing; at most one list per window.

    A partition is its window sums in falling order, empty ones left out, with the
    roots of item trees. Items wait in falling order beside the heap of partitions:
    the imbalance of an item is its size, and that of a partition with empty
    windows its fullest one, so it takes all the items that come next at once.
    """
    count = len(sizes)
    order = np.argsort(-sizes, kind="stable")
    items = sizes[order].astype(np.int64)
    trees: list[tuple[int, int]] = []
    heap: list[tuple[int, int, np.ndarray, np.ndarray]] = []
    at = turn = 0

    def push(sums: np.ndarray, roots: np.ndarray) -> None:
        nonlocal turn
        least = sums[-1] if len(sums) == windows else 0
        heapq.heappush(heap, (int(least - sums[0]), turn, sums, roots))
        turn += 1

    while count - at + len(heap) > 1:
        if at < count and (not heap or items[at] >= -heap[0][0]):
            sums, roots = items[at:at + 1], order[at:at + 1]
            at += 1
        else:
            _, _, sums, roots = heapq.heappop(heap)
        second = -heap[0][0] if heap else -1
        if at == count or items[at] < second:
            _, _, other, theirs = heapq.heappop(heap)
            push(*_united(sums, roots, other, theirs, windows, trees, count))
        elif len(sums) < windows:  # items no smaller than any other imbalance, as many as have a window
            upto = min(count, at + windows - len(sums), int(np.searchsorted(-items, -second, side="right")) if heap else count)
            push(*_united(sums, roots, items[at:upto], order[at:upto], windows, trees, count))
            at = upto
        else:
            push(*_united(sums, roots, items[at:at + 1], order[at:at + 1], windows, trees, count))
            at += 1
    if at < count:
        push(items[at:at + 1], order[at:at + 1])
    found = []
    for root in heap[0][3].tolist() if heap else []:
        members, stack = [], [root]
        while stack:
            node = stack.pop()
            if node < count:
                members.append(node)
            else:
                stack.extend(trees[node - count])
        found.append(sorted(members))
    return found


def windows_of(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Item numbers by window, as few windows as differencing fills without excess."""
    windows = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        found = spread(sizes, windows)
        if all(sizes[items].sum() <= capacity for items in found):
            return found
        windows += 1


class WordTokenizer:
    """A tokenizer whose words are encoded once and remembered, as without special tokens added.

    Added tokens that stand in a text are themselves, as the library has it; a
    text with one is encoded whole, and so is every text if the file's rules are
    not those of ``KNOWN_RULES``. Otherwise splits where its pattern always does: at blanks, tabs and line ends, which it
    drops, and in Latin-1 texts between letters and other characters, except in
    words with an apostrophe. A text's ids are those of its parts one after another.
    Latin-1 texts are put in lower case before, as the tokenizer would.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        rules = json.loads(self.tokenizer.to_str())
        self.in_words = all(rules[k] == v for k, v in KNOWN_RULES.items()) and rules["model"]["type"] == "BPE"
        self.added = [t["content"] for t in rules["added_tokens"]]
        self.words: dict[str, bytes] = {"": b""}
        mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None

    def _encoded(self, words: list[str]) -> dict[str, bytes]:
        """Ids of each word; many words make one call, told apart by a mark between them."""
        plain = [w for w in words if MARK not in w] if self.mark is not None else []
        found: dict[str, bytes] = {}
        runs = [plain[i:i + WORDS_PER_CALL] for i in range(0, len(plain), WORDS_PER_CALL)]
        joined = [f" {MARK} ".join(["", *run, ""]) for run in runs]
        for run, e in zip(runs, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False), strict=True):
            ids = np.array(e.ids, dtype="<u4")
            ends = (4 * np.flatnonzero(ids == self.mark)).tolist()
            packed = ids.tobytes()
            found.update(zip(run, [packed[a + 4:b] for a, b in zip(ends, ends[1:], strict=False)], strict=True))
        rest = [w for w in words if w not in found]
        for w, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            found[w] = np.array(e.ids, dtype="<u4").tobytes()
        return found

    def encode_bytes(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        whole = {i for i, t in enumerate(texts) if not self.in_words or any(a in t for a in self.added)}
        split = [[] if i in whole else PARTS(t.lower()) if LATIN(t) else BETWEEN_WORDS(t) for i, t in enumerate(texts)]
        missing = {w for words in split for w in words}.difference(self.words)
        if missing:
            new = self._encoded(list(missing))
            if len(self.words) + len(new) > MEMO_WORDS:
                self.words = {"": b"", **{w: self.words[w] for words in split for w in words if w in self.words}}
            self.words.update(new)
        found = [b"".join(map(self.words.__getitem__, words)) for words in split]
        encoded = self.tokenizer.encode_batch_fast([texts[i] for i in whole], add_special_tokens=False) if whole else []
        for i, e in zip(whole, encoded, strict=True):
            found[i] = np.array(e.ids, dtype="<u4").tobytes()
        return found


@functools.cache
def load(path: str) -> WordTokenizer:
    """The tokenizer of a file, built once in a process."""
    return WordTokenizer(path)


SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.list_(pa.int32())),
])
COLUMNS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(
    docs: DataFrame, path: str, *, text: str = "text", key: str = "doc_id", end_id: int = 1,
    capacity: int = CAPACITY, piece_ids: int = 256, group_ids: int = 1 << 20, with_ids: bool = True,
) -> DataFrame:
    """One row per piece: where it lies in its document and its sequence, and its ids.

    ``path`` is a tokenizer file that lies on every machine.
    """
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = SCHEMA if with_ids else pa.schema(list(SCHEMA)[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = load(path)
        end = np.array([end_id], dtype="<u4").tobytes()
        number = TaskContext.get().partitionId() << GROUPS_BITS
        rests: list[tuple] = []
        held = 0

        def rows(pieces: list[tuple]) -> pa.RecordBatch:
            columns = [list(c) for c in zip(*pieces, strict=True)]
            packed = columns.pop()
            if with_ids:
                columns.append([np.frombuffer(p, dtype="<u4").astype(np.int32) for p in packed])
            return record_batch(schema, columns)

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number, rests, held
            sizes = np.array([len(r[2]) // 4 for r in rests], dtype=np.int64)
            pieces = []
            for items in windows_of(sizes, capacity) if rests else []:
                offset = 0
                for i in items:
                    doc, start, ids, tokens = rests[i]
                    pieces.append((doc, start, int(sizes[i]), zlib.crc32(ids), tokens, number, offset, ids))
                    offset += int(sizes[i])
                number += 1
            rests, held = [], 0
            if pieces:
                yield rows(pieces)

        for batch, texts in blocks(batches):
            whole = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), coder.encode_bytes(texts), strict=True):
                ids += end
                tokens = len(ids) // 4
                cut = tokens // capacity * capacity
                for start in range(0, cut, capacity):
                    piece = ids[4 * start:4 * (start + capacity)]
                    whole.append((doc, start, capacity, zlib.crc32(piece), tokens, number, 0, piece))
                    number += 1
                for start in range(cut, tokens, piece_ids):
                    rests.append((doc, start, ids[4 * start:4 * (start + piece_ids)], tokens))
                held += tokens - cut
                if held >= group_ids:
                    yield from flush()
            if whole:
                yield rows(whole)
        yield from flush()

    return source.mapInArrow(run, COLUMNS + (", ids array<int>" if with_ids else ""))
