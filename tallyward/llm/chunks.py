"""Repeated passages by content-defined chunks.

A gear rolling hash over a text's bytes sets the borders of chunks, only after
white space, so that chunks hold whole words, and after characters of scripts that
are written without blanks, each of which counts as a word; where both are missing
for long, borders may fall between any characters. A border depends on the few
bytes before it alone: an insertion moves the chunks around it and no others.
Sequences of consecutive chunks that just reach ``least_words`` words are
deduplicated by a rolling digest: of each, the first place (least document, then
position) is kept, and chunks within a sequence that is kept elsewhere are removed.
Common phrases stay, since chunks that repeat one by one make no repeated sequence.

All sequences are sorted once, by ranges of (digest, document, place): a digest
that very many documents have spans several tasks. A task streams its range,
keeps a digest's first place and passes on the later ones; what it cannot know,
whether the digests at its borders began before, is settled by a table of two rows
a task.

Defined results: NULL texts stay NULL and have no chunks; empty texts have none
either. Of repeated rows of a document the first place is the same, so nothing is
removed on their account: documents are told apart by id. Documents with a NULL id
are never changed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import blocks, unused
from tallyward.sources.staging import finished, stage

WORD_BITS = 2
"""A border after one blank in 4, about. The two ends of a repeated passage lose a
chunk each: a passage of 51 words keeps a run of 16 in all but 0.2 % of cases
(in all but 7 % with one border in 8)."""
FAR_BITS = 8
LONGEST = 1024
"""Bytes of a chunk beyond which borders may also fall within words."""
LEAST_WORDS = 16
FACTOR = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(FACTOR), -1, 1 << 64))
GEAR = np.random.Generator(np.random.PCG64(20)).integers(0, 1 << 32, 256, dtype=np.uint64).astype(np.uint32)
SPACES = np.zeros(256, dtype=bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True


def rolling(data: np.ndarray) -> np.ndarray:
    """The gear hash of the 16 bytes that end at each place, by doubling."""
    hashes = GEAR[data]
    for step in (1, 2, 4, 8):
        earlier = hashes[:-step] << np.uint32(step)
        hashes = hashes.copy()
        hashes[step:] += earlier
    return hashes


def characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bytes and ends of the characters of scripts written without blanks.

    By their first bytes in UTF-8: Han and kana with their punctuation, Thai and
    Lao, Burmese and Khmer.
    """
    none = np.zeros(0, dtype=np.int64)
    if not len(data) or data.max() < 0xE0:
        return none, none
    second = np.append(data[1:], 0)
    three = (data >= 0xE3) & (data <= 0xE9)
    three |= (data == 0xE0) & (second >= 0xB8) & (second <= 0xBB)
    three |= (data == 0xE1) & ((second >= 0x80) & (second <= 0x82) | (second >= 0x9E) & (second <= 0x9F))
    four = (data == 0xF0) & (second >= 0xA0) & (second <= 0xB3)
    starts = np.flatnonzero(three | four)
    return starts, starts + np.where(four[starts], 4, 3)


def borders(data: np.ndarray) -> np.ndarray:
    """Ends of the chunks of a text's bytes, the last one included."""
    if not len(data):
        return np.zeros(0, dtype=np.int64)
    hashes = rolling(data)
    space = SPACES[data]
    allowed = space.copy()
    allowed[:-1] &= ~space[1:]  # the last of a run of white space
    allowed[np.minimum(characters(data)[1], len(data)) - 1] = True
    ends = np.flatnonzero(allowed & ((hashes >> np.uint32(12)) & np.uint32((1 << WORD_BITS) - 1) == 0)) + 1
    if not len(ends) or ends[-1] != len(data):
        ends = np.append(ends, len(data))
    gaps = np.diff(ends, prepend=0)
    if (gaps > LONGEST).any():
        whole = np.append((data[1:] & 0xC0) != 0x80, True)  # a character ends here
        far = np.flatnonzero(whole & ((hashes >> np.uint32(12)) & np.uint32((1 << FAR_BITS) - 1) == 0)) + 1
        inside = far[gaps[np.minimum(np.searchsorted(ends, far), len(ends) - 1)] > LONGEST]
        ends = np.union1d(ends, inside)
    return ends


def words_in(data: bytes, ends: np.ndarray) -> np.ndarray:
    """Words of each chunk: runs between blanks, and each character of a script without blanks."""
    if not len(ends):
        return np.zeros(0, dtype=np.int64)
    values = np.frombuffer(data, dtype=np.uint8)[:int(ends[-1])]
    inside = ~SPACES[values]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    own, upto = characters(values)
    begins[own] = True
    after = upto[upto < len(values)]
    begins[after] |= inside[after]
    first = np.append(0, ends[:-1])
    begins[first] |= inside[first]
    return np.add.reduceat(begins, first, dtype=np.int64)


def cut(text: str) -> tuple[bytes, list[int]]:
    data = text.encode("utf-8", "surrogatepass")
    return data, borders(np.frombuffer(data, dtype=np.uint8)).tolist()


def windows(data: bytes, ends: list[int], least_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First chunk, chunk after the last, and digest of the sequences that just reach ``least_words``, from either end."""
    borders = np.array([0, *ends])
    words = np.append(0, np.cumsum(words_in(data, borders[1:])))
    count = len(ends)
    first = np.arange(count)
    after = np.searchsorted(words, words[:-1] + least_words)
    last = np.arange(1, count + 1)
    before = np.searchsorted(words, words[1:] - least_words, side="right") - 1
    keys = np.unique(np.concatenate([
        (first * (count + 1) + after)[after <= count], (before * (count + 1) + last)[before >= 0]]))
    i, j = np.divmod(keys, count + 1)
    digests = np.array([0, *(xxhash.xxh3_64_intdigest(data[x:y]) for x, y in zip(borders[:-1].tolist(), ends, strict=True))], dtype=np.uint64)
    up = np.cumprod(np.append(np.uint64(1), np.full(count, FACTOR)), dtype=np.uint64)
    down = np.cumprod(np.append(np.uint64(1), np.full(count, INVERSE)), dtype=np.uint64)
    sums = np.cumsum(digests * up, dtype=np.uint64)
    return i, j, (sums[j] - sums[i]) * down[i]


def window_table(docs: DataFrame, *, text: str = "text", key: str = "doc_id", least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, place, after and digest of every sequence of chunks that just reaches ``least_words``."""
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).where(
        "doc_id IS NOT NULL AND text IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches):
            found = [windows(*cut(value), least_words) for value in texts]
            ids = np.repeat(batch.column("doc_id").to_numpy(), [len(f[0]) for f in found])
            i, j, digests = (np.concatenate([f[k] for f in found]) for k in range(3))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(digests.view(np.int64))],
                names=["doc_id", "place", "after", "digest"])

    return source.mapInArrow(run, "doc_id long, place int, after int, digest long")


LATER, UNSURE, HEAD = 0, 1, 2


def later_places(found: DataFrame) -> DataFrame:
    """kind, digest, doc_id, place and after: LATER places; and, at the borders of ranges, UNSURE places and HEADs.

    A digest's HEAD is its first place in a range, told of a range's first and last
    digest; places that are first in the range but perhaps not in all are UNSURE.
    """
    order = ["digest", "doc_id", "place"]
    dealt = found.repartitionByRange(*order).sortWithinPartitions(*order)
    names = ["kind", "digest", "doc_id", "place", "after"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head: tuple[int, int, int, int] | None = None  # digest, document, place and after of the digest at hand
        opening = None
        for batch in batches:
            if not batch.num_rows:
                continue
            digest, doc, place, after = (batch.column(c).to_numpy() for c in names[1:])
            fresh = np.append(True, digest[1:] != digest[:-1])
            if head is not None and digest[0] == head[0]:
                fresh[0] = False
            else:
                head = head or (int(digest[0]), int(doc[0]), int(place[0]), int(after[0]))
            if opening is None:
                opening = head
                yield pa.RecordBatch.from_arrays([
                    pa.array([HEAD], pa.int8()), *(pa.array([x], t) for x, t in zip(head, KINDS, strict=True))], names=names)
            at = np.maximum.accumulate(np.where(fresh, np.arange(len(digest)), -1))
            first_doc = np.where(at >= 0, doc[at], head[1])
            first_after = np.where(at >= 0, after[at], head[3])
            later = (doc != first_doc) | (place >= first_after)
            unsure = ~later & (digest == opening[0])
            told = np.flatnonzero(later | unsure)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.where(later[told], LATER, UNSURE).astype(np.int8)), pa.array(digest[told]), pa.array(doc[told]),
                pa.array(place[told]), pa.array(after[told])], names=names)
            if at[-1] >= 0:
                i = int(at[-1])
                head = int(digest[i]), int(doc[i]), int(place[i]), int(after[i])
        if head is not None and head[0] != opening[0]:
            yield pa.RecordBatch.from_arrays([
                pa.array([HEAD], pa.int8()), *(pa.array([x], t) for x, t in zip(head, KINDS, strict=True))], names=names)

    return dealt.mapInArrow(run, "kind tinyint, digest long, doc_id long, place int, after int")


KINDS = (pa.int64(), pa.int64(), pa.int32(), pa.int32())


def repeated_places(docs: DataFrame, *, text: str = "text", key: str = "doc_id", least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id and its chunk places within sequences that are kept elsewhere, as a sorted list.

    The list of a document is bounded by its own length. A sequence that overlaps
    the kept one is no repeat of it.
    """
    told = stage(later_places(window_table(docs, text=text, key=key, least_words=least_words)), "chunks-later")
    first = F.min(F.struct("doc_id", "place", "after")).alias("first")
    heads = told.where(F.col("kind") == HEAD).groupBy("digest").agg(first)  # two rows a task at most
    unsure = told.where(F.col("kind") == UNSURE).join(heads, "digest").where(
        "doc_id <> first.doc_id OR place >= first.after")
    later = told.where(F.col("kind") == LATER).unionByName(unsure.drop("first"))
    spans = later.groupBy("doc_id", "place").agg(F.max("after").alias("after"))
    return spans.select("doc_id", F.explode(F.sequence("place", F.col("after") - 1)).alias("place")).groupBy("doc_id").agg(
        F.array_sort(F.collect_set("place")).alias("places"))


def remove_runs(text: str, places: list[int], least_words: int) -> tuple[str, list[tuple[int, int]]]:
    """The text without its long runs of repeated chunks, and the removed (start, end) in UTF-8 bytes."""
    data, ends = cut(text)
    starts = [0, *ends]
    spans: list[list[int]] = []
    for place in places:
        if spans and spans[-1][1] == starts[place]:
            spans[-1][1] = ends[place]
        else:
            spans.append([starts[place], ends[place]])
    gone = [(a, b) for a, b in spans if int(words_in(data[a:b], np.array([b - a]))[0]) >= least_words]
    kept, at = [], 0
    for a, b in gone:
        kept.append(data[at:a])
        at = b
    kept.append(data[at:])
    return b"".join(kept).decode("utf-8", "surrogatepass"), gone


def deduplicate(
    docs: DataFrame, *, text: str = "text", key: str = "doc_id", least_words: int = LEAST_WORDS, removed: str = "removed",
) -> DataFrame:
    """All rows and columns of ``docs`` with the text cut, and ``removed``: the spans, in bytes of the old text.

    A column of that name in ``docs`` is replaced.
    """
    columns = [c for c in docs.columns if c.lower() != removed.lower()]
    own, marks = unused(docs, "cut_doc"), unused(docs, "places")
    places = finished(lambda: repeated_places(docs, text=text, key=key, least_words=least_words), "chunks-places")
    places = places.withColumnsRenamed({"doc_id": own, "places": marks})
    joined = docs.select(*columns).join(places, docs[key].cast("long") == F.col(own), "left")
    at = {c: i for i, c in enumerate(columns)}
    spans = "array<struct<start:bigint,end:bigint>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch, texts in blocks(batches, text):
            null = batch.column(text).is_null().to_pylist()
            done = [
                remove_runs(t, p, least_words) if p else (t, [])
                for t, p in zip(texts, batch.column(marks).to_pylist(), strict=True)
            ]
            arrays = [batch.column(c) for c in columns]
            arrays[at[text]] = pa.array([None if n else d[0] for n, d in zip(null, done, strict=True)], pa.string())
            arrays.append(pa.array([[{"start": a, "end": b} for a, b in d[1]] for d in done], kind))
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, removed])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema)
    return joined.select(*columns, marks).mapInArrow(run, f"{fields}, `{removed}` {spans}")
