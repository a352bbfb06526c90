"""Document fingerprints from improbable features.

A feature is a window of 32 bytes; its rank is how rare its byte entropy is in a
table fixed by rule: windows of middling entropy are what running text is made of,
windows of low entropy repeat themselves, so both tell little, and a window ranks
by how far it lies from the common value. Among each 32 neighbouring windows the
best one gets a vote; windows with half of the possible votes are kept. Kept
features go to Bloom filters of 2048 bits, 128 to a filter, then a new one
follows. Two chains are alike as far as the bits of their filters overlap beyond
what chance gives, each filter of the shorter chain held against its best match.

Defined results: NULL is read as the empty text. Texts without a kept feature
(shorter than a window) have the digest of the whole text as their only feature,
so equal texts have equal fingerprints and likeness 1. Ranks tie in favour of the
earlier window.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 32
NEIGHBOURS = 32
VOTES = 16
FILTER_BITS = 2048
FEATURES_PER_FILTER = 128
HASHES = 5
UNIT = 1 << 20
"""Entropies are sums of whole numbers, so that equal windows rank alike at any place."""
STRIP = 1 << 16
PART = 1 << 20

_COUNTS = np.arange(WINDOW + 1)
_TERMS = np.round(UNIT * _COUNTS * np.log2(np.maximum(_COUNTS, 1))).astype(np.int64)
GAIN = np.diff(_TERMS)
"""What the c-th further occurrence of a byte adds to the sum of c * log2(c)."""
COMMON = int(UNIT * WINDOW * (np.log2(WINDOW) - 3.5))
"""Fixed value: the sum at 3.5 bits, about the entropy of 32 letters of prose."""


def window_sums(data: np.ndarray) -> np.ndarray:
    """Sum of c * log2(c) over the byte counts c of every window: entropy, upside down."""
    size = len(data)
    if size < WINDOW:
        return np.zeros(0, dtype=np.int64)
    before = np.zeros(size, dtype=np.uint8)  # equal bytes among the 31 before
    after = np.zeros(size, dtype=np.uint8)  # and after
    for lo in range(0, size, STRIP):  # strips that stay in the processor's cache
        hi = min(size, lo + STRIP)
        for step in range(1, WINDOW):
            first = max(lo, step)
            if first >= hi:
                break
            same = data[first:hi] == data[first - step:hi - step]
            before[first:hi] += same
            after[first - step:hi - step] += same
    come = np.cumsum(GAIN[before])
    go = np.cumsum(GAIN[after])
    sums = come[WINDOW - 1:].copy()
    sums[1:] -= go[:size - WINDOW]
    return sums


def kept_features(data: np.ndarray) -> np.ndarray:
    """Starts of the windows with enough votes."""
    rank = np.abs(window_sums(data) - COMMON)
    count = len(rank)
    if not count:
        return np.zeros(0, dtype=np.int64)
    # rarest first: a larger distance is a smaller key, then the earlier place
    key = ((1 << 34) - rank) * (1 << 28) + np.arange(count)
    reach = min(NEIGHBOURS, count)
    best, width = key, 1
    while width < reach:
        step = min(width, reach - width)
        best = np.minimum(best[:-step], best[step:])
        width += step
    winner = best & ((1 << 28) - 1)
    starts = np.flatnonzero(np.diff(winner, prepend=-1))
    votes = np.diff(np.append(starts, len(winner)))
    return winner[starts][votes >= min(VOTES, len(winner))]


def features(text: bytes) -> np.ndarray:
    """64-bit hashes of the kept windows, in order."""
    data = np.frombuffer(text, dtype=np.uint8)
    found = []
    # whole texts, in overlapping parts that bound memory and the width of a place
    for lo in range(0, max(1, len(data)), PART):
        found.append(lo + kept_features(data[lo:lo + PART + WINDOW - 1]))
    places = np.concatenate(found)
    if not len(places):
        return np.array([xxhash.xxh3_64_intdigest(text)], dtype=np.uint64)
    windows = np.lib.stride_tricks.sliding_window_view(data, WINDOW)[places]
    words = np.ascontiguousarray(windows).view("<u8")
    mixed = np.zeros(len(places), dtype=np.uint64)
    for column in range(words.shape[1]):
        mixed = (mixed ^ words[:, column]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed * np.uint64(0xBF58476D1CE4E5B9) ^ (mixed >> np.uint64(32))



class Fingerprint(NamedTuple):
    """A chain of Bloom filters, as bits by row, and the set bits of each."""

    filters: np.ndarray
    ones: np.ndarray

    @classmethod
    def of(cls, text: bytes) -> Fingerprint:
        hashes = features(text)
        chain = -(-len(hashes) // FEATURES_PER_FILTER)
        filters = np.zeros((chain, FILTER_BITS // 64), dtype=np.uint64)
        row = np.arange(len(hashes)) // FEATURES_PER_FILTER
        for turn in range(HASHES):
            bit = (hashes >> np.uint64(11 * turn)) & np.uint64(FILTER_BITS - 1)
            np.bitwise_or.at(filters, (row, (bit >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (bit & np.uint64(63)))
        return cls(filters, np.bitwise_count(filters).sum(axis=1, dtype=np.int64))

    def text(self) -> str:
        return base64.b64encode(self.filters.astype("<u8").tobytes()).decode()

    @classmethod
    def parse(cls, text: str) -> Fingerprint:
        filters = np.frombuffer(base64.b64decode(text), dtype="<u8").reshape(-1, FILTER_BITS // 64)
        return cls(filters, np.bitwise_count(filters).sum(axis=1, dtype=np.int64))

    def likeness(self, other: Fingerprint) -> float:
        """Mean over the shorter chain of the best normalised overlap, 0 to 1; symmetric."""
        short, long = (self, other) if len(self.ones) <= len(other.ones) else (other, self)
        if len(short.ones) == len(long.ones):
            return (short._against(long) + long._against(short)) / 2
        return short._against(long)

    def _against(self, other: Fingerprint) -> float:
        total = 0.0
        for bits, ones in zip(self.filters, self.ones, strict=True):
            common = np.bitwise_count(bits & other.filters).sum(axis=1, dtype=np.int64)
            chance = ones * other.ones / FILTER_BITS
            most = np.minimum(ones, other.ones)
            total += float(np.clip((common - chance) / np.maximum(most - chance, 1e-9), 0, 1).max())
        return min(1.0, total / len(self.ones))


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by the beginning of the following text."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


def fingerprints(docs: DataFrame, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key`` and fingerprint of each whole text."""
    source = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = source.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Fingerprint.of((t or "").encode("utf-8", "surrogatepass")).text() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found, pa.string())], names=["key", "fingerprint"])

    return source.mapInArrow(run, f"key {kind}, fingerprint string").withColumnRenamed("key", key)


OUT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def with_next(
    docs: DataFrame, *, text: str = "text", key: str = "doc_id", rows_per_range: int = 2000, most_ranges: int = 8192,
) -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likeness; the next text is that of the next smaller id.

    Rows are dealt once, by ranges of ids; the first row of each range goes to the
    range before as well. The ranges follow from quantiles of the ids; their number,
    and so what the driver knows of them, is bounded, not the rows of one.
    Rows with a NULL id come last; equal ids follow each other by the hash of the
    text. The last row of all is followed by the first.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    order = F.coalesce("doc_id", F.lit(-(1 << 63)))
    place = rows.select(order.cast("double").alias("place"))
    parts = max(1, min(most_ranges, place.count() // rows_per_range))
    shares = [i / parts for i in range(1, parts)]
    cuts = sorted(set(place.approxQuantile("place", shares, 0.1 / parts))) if shares else []
    # Bucketizer wants two ranges at least
    splits = [-math.inf, *(cuts or [0.0]), math.inf]
    ranges = Bucketizer(splits=splits, inputCol="place", outputCol="bucket")
    ranged = ranges.transform(rows.withColumn("place", order.cast("double"))).withColumn(
        "part", F.lit(len(splits)) - F.col("bucket").cast("int")).drop("place", "bucket")
    # one row per range: its first row by (id, text digest), whatever the size of the table
    heads = ranged.groupBy("part").agg(F.max(F.struct(order.alias("o"), F.xxhash64("text").alias("h"))).alias("head")).collect()
    firsts = sorted((r["part"], r["head"]["o"], r["head"]["h"]) for r in heads)
    before = {firsts[i][0]: firsts[i - 1][0] for i in range(len(firsts))}  # the first range's head follows the last
    table = spark.createDataFrame(
        [(p, o, h, before[p]) for p, o, h in firsts] or [(0, 0, 0, 0)], "part int, o long, h long, to_part int")
    dealt = ranged.withColumns({"o": order, "h": F.xxhash64("text")})
    own = dealt.select("doc_id", "text", "o", "h", "part", F.lit(False).alias("guest"))
    guests = dealt.join(F.broadcast(table), ["part", "o", "h"]).select(
        "doc_id", "text", "o", "h", F.col("to_part").alias("part"), F.lit(True).alias("guest"))
    width = max(1, len(firsts))
    # each document is in one range, and one per range in two
    met = own.unionByName(guests).repartition(width, "part").sortWithinPartitions(
        "part", "guest", F.desc("o"), F.desc("h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (part, id, text, fingerprint) still without its next row
        for batch in batches:
            out = []
            for doc, value, part, guest in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "part", "guest")), strict=True):
                if guest and held is None:  # a second copy of the same head
                    continue
                value = value or ""
                print_ = Fingerprint.of(value.encode("utf-8", "surrogatepass"))
                if held is not None:
                    out.append(row(held, value, print_))
                held = None if guest else (doc, value, print_)
            yield pa.RecordBatch.from_pylist(out, schema=SCHEMA)

    def row(held: tuple, following: str, next_print: Fingerprint) -> dict:
        doc, value, own_print = held
        changed = edited(value, following).encode("utf-8", "surrogatepass")
        other = Fingerprint.of(changed)
        return {
            "doc_id": doc, "n_chars": len(value), "edited_sha256": hashlib.sha256(changed).hexdigest(),
            "fingerprint": own_print.text(), "edited_fingerprint": other.text(),
            "near_edited": own_print.likeness(other), "near_next": own_print.likeness(next_print),
        }

    return met.mapInArrow(run, OUT)


SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
])
