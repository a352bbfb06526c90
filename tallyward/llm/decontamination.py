"""Benchmark decontamination by normalised n-grams.

Benchmark items become windows of ``size`` consecutive words (A-Z in lower case,
words of letters, digits and bytes beyond ASCII); an item of fewer words, but not
none, is one window. Their hashes are broadcast with the windows. A task hashes
every window of its documents at once, looks the hashes up, compares the words of
each hit with the window's, and marks the words inside. Documents can then lose
the marked spans or be dropped.

What is broadcast is bounded by ``block_bytes``: (window, item) pairs beyond it
are dealt into blocks by a hash, the documents are scanned once for each block,
and what the blocks found is joined by the text's digest.

Defined results: a NULL text has no words, like an empty one, and is never hit.
Items with a NULL id go by the empty id, repeated ids are one item, items without
words occur nowhere. Equal rows get equal results. An empty table of items hits
nothing. A column of ``docs`` with the name of a new one is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import blocks, lower_bytes, unused
from tallyward.sources.staging import stage

SIZE = 10
BLOCK_BYTES = 32 << 20
WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
IN_WORD = np.ones(256, dtype=bool)
IN_WORD[0x00:0x30] = IN_WORD[0x3A:0x61] = IN_WORD[0x7B:0x80] = False
SLAB = 1 << 18
"""Bytes whose words are hashed at once."""
FACTOR = 0x9E3779B97F4A7C15
POWERS = np.cumprod(np.append(np.uint64(1), np.full(SLAB, FACTOR, dtype=np.uint64)))
INVERSES = np.cumprod(np.append(np.uint64(1), np.full(SLAB, pow(FACTOR, -1, 1 << 64), dtype=np.uint64)))
FILTER_BITS = 22


def word_borders(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of lower-case bytes."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = IN_WORD[data]
    turns = np.flatnonzero(np.diff(inside))
    return turns[::2], turns[1::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word, from sums of bytes times powers; of very long words the beginning counts, as hits are verified."""
    found = np.zeros(len(starts), dtype=np.uint64)
    shown = np.minimum(ends, starts + SLAB // 2)
    at = 0
    while at < len(starts):
        low = starts[at]
        upto = max(at + 1, int(np.searchsorted(shown, low + SLAB, side="right")))
        sums = np.zeros(int(shown[upto - 1] - low) + 1, dtype=np.uint64)
        np.cumsum((data[low:shown[upto - 1]].astype(np.uint64) + 1) * POWERS[:len(sums) - 1], out=sums[1:])
        a, b = starts[at:upto] - low, shown[at:upto] - low
        found[at:upto] = (sums[b] - sums[a]) * INVERSES[a]
        at = upto
    return mixed(found)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over the upper half as well."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(count, dtype=np.uint64)
    for j in range(size):
        total += words[j:j + count] * POWERS[j]
    return mixed(total)


def hash_of(window: bytes) -> int:
    """The hash of a window given as its words with a space between each two."""
    data = np.frombuffer(window, dtype=np.uint8)
    words = word_hashes(data, *word_borders(data))
    return int(window_hashes(words, len(words))[0])


def item_windows(item: str, size: int) -> list[bytes]:
    """The windows of an item's text, its words with a space between each two."""
    words = WORD.findall(lower_bytes(item))
    return list(dict.fromkeys(
        b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1)))) if words else []


class Windows:
    """Lookup of one block of (window, item) pairs."""

    def __init__(self, pairs: list[tuple[bytes, str]]) -> None:
        self.items: dict[bytes, list[str]] = {}
        for window, item in pairs:
            self.items.setdefault(window, []).append(item)
        by_size: dict[int, list[int]] = {}
        for window in self.items:
            by_size.setdefault(window.count(b" ") + 1, []).append(hash_of(window))
        self.hashes = {}
        for size, hashes in by_size.items():
            table = np.unique(np.array(hashes, dtype=np.uint64))
            may = np.zeros(1 << FILTER_BITS, dtype=bool)
            may[table >> np.uint64(64 - FILTER_BITS)] = True
            self.hashes[size] = table, may

    def hits(self, data: bytes, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
        """First word, number of words and window of every place where a window stands within one row."""
        words = word_hashes(np.frombuffer(data, dtype=np.uint8), starts, ends)
        for size, (table, may) in self.hashes.items():
            hashes = window_hashes(words, size)
            first = np.flatnonzero(may[hashes >> np.uint64(64 - FILTER_BITS)])
            first = first[rows[first] == rows[first + size - 1]]
            near = np.minimum(np.searchsorted(table, hashes[first]), len(table) - 1)
            for i in first[table[near] == hashes[first]].tolist():
                a, b = starts[i:i + size].tolist(), ends[i:i + size].tolist()
                window = b" ".join([data[x:y] for x, y in zip(a, b, strict=True)])
                if window in self.items:
                    yield i, size, window


@dataclass
class Found:
    """What a document holds: its words' number and, of its hit words, number, runs (byte places) and items."""

    n_words: int
    n_hit: int
    spans: list[tuple[int, int]]
    items: set[str]


def scan(texts: list[str], windows: Windows) -> list[Found]:
    """Hits of each text; all texts are scanned in one go."""
    parts = [lower_bytes(t) for t in texts]
    data = b"\n".join([*parts, b""])
    begins = np.cumsum([0, *(len(p) + 1 for p in parts)])
    starts, ends = word_borders(np.frombuffer(data, dtype=np.uint8))
    rows = np.searchsorted(begins, starts, side="right") - 1
    change = np.zeros(len(starts) + 1, dtype=np.int64)
    items: dict[int, set[str]] = {}
    for i, size, window in windows.hits(data, starts, ends, rows):
        change[i] += 1
        change[i + size] -= 1
        items.setdefault(int(rows[i]), set()).update(windows.items[window])
    counts = np.bincount(rows, minlength=len(texts)).tolist()
    found = [Found(n, 0, [], items.get(r, set())) for r, n in enumerate(counts)]
    hit = np.flatnonzero(np.cumsum(change[:-1]) > 0)
    if len(hit):
        apart = (np.diff(hit) > 1) | (np.diff(rows[hit]) > 0)
        first, last = hit[np.append(True, apart)], hit[np.append(apart, True)]
        for row, a, b, n in zip(rows[first].tolist(), starts[first].tolist(), ends[last].tolist(),
                                (last - first + 1).tolist(), strict=True):
            found[row].spans.append((a - int(begins[row]), b - int(begins[row])))
            found[row].n_hit += n
    return found


def window_pairs(items: DataFrame, *, text: str = "text", key: str = "item_id", size: int = SIZE) -> DataFrame:
    """Distinct (window, item_id) of all items."""
    source = items.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches):
            found = [item_windows(t, size) for t in texts]
            ids = batch.column("item_id").take(pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found])))
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for f in found for w in f], pa.binary()), ids], names=["window", "item_id"])

    return source.mapInArrow(run, "window binary, item_id string").distinct()


NEW = "n_words long, n_hit long, item_ids array<string>, spans array<struct<start:bigint,end:bigint>>"
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _arrays(found: list[Found]) -> list[pa.Array]:
    return [
        pa.array([f.n_words for f in found], pa.int64()), pa.array([f.n_hit for f in found], pa.int64()),
        pa.array([sorted(f.items) for f in found], pa.list_(pa.string())),
        pa.array([[{"start": a, "end": b} for a, b in f.spans] for f in found], SPANS),
    ]


def _mapped(
    docs: DataFrame, text: str, kept: list[str],
    find: Callable[[pa.RecordBatch, list[str]], list[Found]], extra: list[str],
) -> DataFrame:
    """``kept`` columns and those of NEW, which ``find`` gives from a batch and its texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, text):
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *_arrays(find(batch, texts))],
                names=[*kept, "n_words", "n_hit", "item_ids", "spans"])

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema)
    return docs.select(*kept, *extra).mapInArrow(run, f"{own}, {NEW}")


def find(
    docs: DataFrame, items: DataFrame, *, text: str = "text", item_text: str = "text", item_key: str = "item_id",
    size: int = SIZE, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """All columns of ``docs``, and n_words, n_hit, item_ids (sorted) and spans (bytes of the hit runs).

    An action counts the items' windows before the plan is made. The text column
    keeps its place; it must not bear the name of a new one.
    """
    new = ("n_words", "n_hit", "item_ids", "spans")
    kept = [c for c in docs.columns if c.lower() not in new]
    docs = docs.select(*(F.col(c).cast("string").alias(c) if c == text else F.col(c) for c in kept))
    pairs = stage(window_pairs(items, text=item_text, key=item_key, size=size), "item-windows")
    total = pairs.agg(F.sum(F.octet_length("window") + F.octet_length("item_id") + 16)).first()[0] or 0
    count = max(1, -(-total // block_bytes))
    context = docs.sparkSession.sparkContext
    block = F.pmod(F.xxhash64("window", "item_id"), F.lit(count))

    def sent(number: int) -> Broadcast:
        part = pairs.where(block == number) if count > 1 else pairs
        return context.broadcast([(bytes(r[0]), r[1]) for r in part.collect()])  # bounded: one block

    def scanner(held: Broadcast) -> Callable[[pa.RecordBatch, list[str]], list[Found]]:
        made: list[Windows] = []

        def run(batch: pa.RecordBatch, texts: list[str]) -> list[Found]:
            if not made:
                made.append(Windows(held.value))
            return scan(texts, made[0])

        return run

    if count == 1:
        return _mapped(docs, text, kept, scanner(sent(0)), [])
    whole = docs.select(F.col(text).alias("text"))
    digest, seen = unused(docs, "digest"), unused(docs, "seen")
    hits = None
    for number in range(count):
        part = _mapped(whole, "text", ["text"], scanner(sent(number)), []).where("n_hit > 0")
        part = part.select(F.sha2("text", 256).alias(digest), F.struct("item_ids", "spans").alias(seen))
        part = stage(part.dropDuplicates([digest]), "block-hits")
        hits = part if hits is None else hits.unionByName(part)
    # one row a block at most; staged, so that the join may split a text that many documents have
    by_text = stage(hits.groupBy(digest).agg(F.collect_list(seen).alias(seen)), "hits")
    joined = docs.withColumn(digest, F.sha2(F.coalesce(text, F.lit("")), 256)).join(by_text, digest, "left")

    def united(batch: pa.RecordBatch, texts: list[str]) -> list[Found]:
        return [_united(t, s or []) for t, s in zip(texts, batch.column(seen).to_pylist(), strict=True)]

    return _mapped(joined, text, kept, united, [seen])


def _united(text: str, seen: list[dict]) -> Found:
    """What the blocks found in a text, as one: words within any span are hit."""
    data = lower_bytes(text)
    starts, ends = word_borders(np.frombuffer(data, dtype=np.uint8))
    hit = np.zeros(len(starts) + 1, dtype=bool)
    for s in (s for part in seen for s in part["spans"]):
        hit[np.searchsorted(starts, s["start"]):np.searchsorted(starts, s["end"])] = True
    turns = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8)])))
    spans = [(int(starts[a]), int(ends[b - 1])) for a, b in zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True)]
    return Found(len(starts), int(hit.sum()), spans, {i for part in seen for i in part["item_ids"]})


def without_spans(found: DataFrame, text: str = "text") -> DataFrame:
    """The rows of :func:`find` with the hit spans cut out of the text; a text without hits stays as it is."""
    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([_cut(t, s) for t, s in zip(texts, spans, strict=True)], dtype=object)

    return found.withColumn(text, F.when(F.col("n_hit") > 0, cut(text, "spans")).otherwise(F.col(text)))


def _cut(text: str | None, spans: list[dict]) -> str | None:
    if text is None:
        return None
    data, kept, at = text.encode("utf-8", "surrogatepass"), [], 0
    for s in spans:
        kept.append(data[at:s["start"]])
        at = s["end"]
    return b"".join([*kept, data[at:]]).decode("utf-8", "surrogatepass")


def without_documents(found: DataFrame, least_share: float = 0.0) -> DataFrame:
    """The rows of :func:`find` of which no more than ``least_share`` of the words is hit."""
    return found.where(F.col("n_hit") <= F.lit(least_share) * F.col("n_words"))
