"""Alignment of two tokenizers by divide and conquer at shared cuts.

Both tokenizers' tokens are runs of the same bytes, so each is a rising list of
byte ends. An interval of both lists is divided at a common end near its middle,
which is looked for outwards from the middle of one list by bisecting the other,
and both halves are treated alike; an interval without a common end inside is a
leaf, one group. A stretch without cuts is searched three times at most: by the
searches that find its two borders, and as a leaf. So the work is n log n. All
intervals of a round, over a block of texts, are searched at once.

Where both tokenizers are known to end tokens before a single space, a text is
tokenized in units that begin there, whose ids are remembered for a time.
Links of tokens whose bytes overlap are counted over the corpus by Spark; the
counts go back to the documents by a broadcast of checked size, and by a shuffle
beyond it.

Defined results: texts that are NULL or empty, or whose tokens of either kind do
not spell a space and the text (such as texts that hold U+2581), have no tokens:
their numbers are 0, their groups and links empty. Special tokens' strings are
ordinary text. Repeated rows are aligned and counted once each; an empty table
gives no rows. Other columns of the table are not read.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyward.llm.common import blocks
from tallyward.sources.staging import stage

MEMO_WORDS = 400_000
MEMO_IDS = 1 << 23
ALIGNED_BYTES = 1 << 20
"""Text that is aligned at once: its tokens' arrays stay within a processor's cache, or near it."""
WORDS_PER_CALL = 200
FEW = 8
"""So few intervals are searched on their own."""
BROADCAST_PAIRS = 1 << 21
"""Linked pairs of ids that are broadcast at most (some 100 MB); more are joined by a shuffle."""
MARK = "▁"
RUN_WITH_SPACE = re.compile(r" \s|\s | $").search
BEFORE_SPACE = re.compile(r"(?<=\S)(?= \S)").split
PROBE = "a  b ﬁ \xbd é A\xa0z\t　 c "
"""Text that a normaliser would change: blanks at the ends and in runs, ligatures, fractions, accents, capitals."""


def byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones themselves, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in shown}
    hidden = [b for b in range(256) if b not in set(shown)]
    letters.update({chr(0x100 + i): b for i, b in enumerate(hidden)})
    return letters


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> np.ndarray:
    """Whether each token of A ends where one of B does.

    Ends rise over all texts; ``last_a`` and ``last_b`` are the last tokens of each
    text, which end alike.
    """
    cut = np.zeros(len(ends_a), dtype=bool)
    cut[last_a] = True
    # intervals by their first and last tokens; the last ones end alike
    a0, a1 = np.append(0, last_a[:-1] + 1), last_a
    b0, b1 = np.append(0, last_b[:-1] + 1), last_b
    while True:
        open_ = (a0 < a1) & (b0 < b1)
        a0, a1, b0, b1 = a0[open_], a1[open_], b0[open_], b1[open_]
        if not len(a0):
            return cut
        at = _near_middle(ends_a, ends_b, a0, a1)
        divided = at >= 0
        at, a0, a1, b0, b1 = at[divided], a0[divided], a1[divided], b0[divided], b1[divided]
        cut[at] = True
        partner = np.searchsorted(ends_b, ends_a[at])
        # both halves side by side, so that the searches of a round go up through the lists
        a0, a1 = np.column_stack([a0, at + 1]).ravel(), np.column_stack([at, a1]).ravel()
        b0, b1 = np.column_stack([b0, partner + 1]).ravel(), np.column_stack([partner, b1]).ravel()


def _shared(ends_a: np.ndarray, ends_b: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Whether the given tokens of A end where one of B does, by bisecting B."""
    ends = ends_a[tokens]
    return ends_b[np.searchsorted(ends_b, ends)] == ends


def _near_middle(ends_a: np.ndarray, ends_b: np.ndarray, a0: np.ndarray, a1: np.ndarray) -> np.ndarray:
    """The token of each interval that ends at a shared cut nearest to its middle; -1 if only the last one does."""
    found = np.full(len(a0), -1)
    left = (a0 + a1 - 1) // 2
    right = left + 1
    pending = np.arange(len(a0))
    while len(pending) > FEW:
        for side in (left, right):
            i = side[pending]
            inside = (a0[pending] <= i) & (i < a1[pending])
            here, i = pending[inside], i[inside]
            hit = _shared(ends_a, ends_b, i) & (found[here] < 0)
            found[here[hit]] = i[hit]
        left, right = left - 1, right + 1
        pending = pending[(found[pending] < 0) & ((left[pending] >= a0[pending]) | (right[pending] < a1[pending]))]
    for p in pending.tolist():  # the few that are left may be long: ever larger steps
        low, high, step = int(left[p]), int(right[p]), 64
        while found[p] < 0 and (low >= a0[p] or high < a1[p]):
            below = np.arange(max(int(a0[p]), low - step + 1), low + 1)
            above = np.arange(high, min(int(a1[p]), high + step))
            near = [x[_shared(ends_a, ends_b, x)] for x in (below, above)]
            either = [*near[0][-1:].tolist(), *near[1][:1].tolist()]
            if either:
                found[p] = min(either, key=lambda x: (low - x if x <= low else x - high, x))
            low, high, step = low - step, high + step, 2 * step
    return found


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of A and of B whose bytes overlap, pair by pair; both lists end alike."""
    starts = np.append(0, ends_a[:-1])
    first = np.searchsorted(ends_b, starts, side="right")
    count = np.searchsorted(ends_b, ends_a) - first + 1
    a = np.repeat(np.arange(len(ends_a)), count)
    before = np.cumsum(count) - count
    return a, np.arange(len(a)) - np.repeat(before - first, count)


class Aligner:
    """Aligns tokens of a byte-level BPE file (A) with those of a sentencepiece model (B)."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_of_letter()
        bytes_a = {
            i: bytes(map(letters.__getitem__, token)) if set(token) <= letters.keys() else token.encode()
            for token, i in self.a.get_vocab().items()}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        made = json.loads(self.a.to_str())
        first = made["pre_tokenizer"] or {}
        self.in_units = (
            made["normalizer"] is None and {bytes([b]) for b in range(256)} <= set(bytes_a.values())  # A loses nothing
            and first.get("type") == "ByteLevel" and first.get("use_regex", True)
            and not first.get("add_prefix_space") and made["post_processor"] is None
            and not any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces)
            and sentencepiece.SentencePieceNormalizer(model_file=path_b).normalize(PROBE) == MARK + PROBE.replace(" ", MARK))
        # bytes of an id of A and of B, and their number
        self.spellings = [np.array(side, dtype=object) for side in (
            [bytes_a.get(i, b"") for i in range(max(bytes_a) + 1)], bytes_b)]
        self.sizes = [np.array([len(x) for x in side], dtype=np.int64) for side in self.spellings]
        # text of an id within a group, and as the last of its side
        self.shown = [
            np.array([b"%d%s" % (i, mark) for mark in (b",", last) for i in range(len(side))], dtype=object)
            for side, last in zip(self.sizes, (b"|", b";"), strict=True)]
        # of each remembered word its number; of each number where its ids by A and by B lie, or that it is not spelled
        self.number: dict[str, int] = {}
        self.ids = [np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)]
        self.begins = [np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)]
        self.spelled = np.zeros(0, dtype=bool)

    def words(self, text: str) -> list[str]:
        """The units of a text, each without the space it begins with."""
        if not self.in_units:
            return [text]
        whole = f" {text}"
        if RUN_WITH_SPACE(whole):
            return [unit[1:] for unit in BEFORE_SPACE(whole)]
        return text.split(" ")

    def _learn(self, words: list[str]) -> None:
        """Remember the ids of new words."""
        data = [b" " + w.encode("utf-8", "surrogatepass") for w in words]
        both = self._ids_a(words, data), self._flat(self.b.encode(words, num_threads=1))
        lengths = np.array([len(d) for d in data])
        whole = b"".join(data)
        spelled = np.ones(len(words), dtype=bool)
        for side, (ids, bounds) in enumerate(both):
            sizes, table, sure = self.sizes[side], self.spellings[side], self.in_units and side == 0
            reached = np.append(0, np.cumsum(sizes[ids]))[bounds]
            alike = np.diff(reached) == lengths
            if not alike.all() or not sure and b"".join(table[ids].tolist()) != whole:  # rare: word by word
                each = zip(bounds.tolist(), bounds[1:].tolist(), data, strict=False)
                alike = np.array([b"".join(table[ids[x:y]].tolist()) == d for x, y, d in each], dtype=bool)
            spelled &= alike
            self.begins[side] = np.concatenate([self.begins[side], bounds[1:] + len(self.ids[side])])
            self.ids[side] = np.concatenate([self.ids[side], ids])
        self.spelled = np.concatenate([self.spelled, spelled])
        count = len(self.number)
        self.number.update(zip(words, range(count, count + len(words)), strict=True))

    def _forget(self, wanted: set[str]) -> None:
        """Keep what is in use."""
        kept = [w for w in wanted if w in self.number]
        which = np.array([self.number[w] for w in kept], dtype=np.int64)
        for side in (0, 1):
            ids, bounds = self._gathered(side, which)
            self.ids[side], self.begins[side] = ids, bounds
        self.spelled = self.spelled[which]
        self.number = {w: i for i, w in enumerate(kept)}

    def _gathered(self, side: int, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words of these numbers one after another, and the bounds of each."""
        first = self.begins[side][which]
        counts = self.begins[side][which + 1] - first
        bounds = np.append(0, np.cumsum(counts))
        return self.ids[side][np.repeat(first - bounds[:-1], counts) + np.arange(bounds[-1])], bounds

    @staticmethod
    def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the bounds of each list."""
        bounds = np.cumsum([0, *map(len, ids)])
        return np.fromiter(chain.from_iterable(ids), dtype=np.int64, count=int(bounds[-1])), bounds

    def _ids_a(self, words: list[str], data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """A's ids; words without blanks at their ends make one call by the hundred, told apart by their bytes."""
        plain = [self.in_units and w != "" and not w[0].isspace() and not w[-1].isspace() for w in words]
        order = [i for i, p in enumerate(plain) if p]
        calls = [order[i:i + WORDS_PER_CALL] for i in range(0, len(order), WORDS_PER_CALL)]
        calls += [[i] for i, p in enumerate(plain) if not p]
        texts = [" " + " ".join([words[i] for i in call]) for call in calls]
        ids, _ = self._flat([e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)])
        places = [i for call in calls for i in call]
        ends = np.cumsum(self.sizes[0][ids])
        bounds = np.append(0, np.searchsorted(ends, np.cumsum([len(data[i]) for i in places]), side="right"))
        if len(order) == len(words):
            return ids, bounds
        counts, begins = np.empty(len(words), dtype=np.int64), np.empty(len(words), dtype=np.int64)
        counts[places], begins[places] = np.diff(bounds), bounds[:-1]
        upto = np.cumsum(counts)
        return ids[np.repeat(begins - (upto - counts), counts) + np.arange(len(ids))], np.append(0, upto)

    def tokens(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of all texts by A and by B, and each text's number of them; none for a text without tokens."""
        split = [self.words(t) if t else [] for t in texts]
        wanted = set().union(*split)
        missing = list(wanted.difference(self.number))
        if len(self.number) + len(missing) > MEMO_WORDS or len(self.ids[0]) > MEMO_IDS:
            self._forget(wanted)
        if missing:
            self._learn(missing)
        upto = np.cumsum([0, *map(len, split)])
        which = np.fromiter(map(self.number.__getitem__, chain.from_iterable(split)), dtype=np.int64, count=int(upto[-1]))
        unspelled = np.append(0, np.cumsum(~self.spelled[which]))
        good = unspelled[upto[1:]] == unspelled[upto[:-1]]
        if not good.all():
            sizes = np.diff(upto)
            which = which[np.repeat(good, sizes)]
            upto = np.append(0, np.cumsum(sizes * good))
        sides = [self._gathered(side, which) for side in (0, 1)]
        return [ids for ids, _ in sides], [np.diff(bounds[upto]) for _, bounds in sides]

    def align(self, texts: list[str]) -> Aligned:
        (ids_a, ids_b), counts = self.tokens(texts)
        upto = [np.cumsum(c) for c in counts]
        ends_a, ends_b = np.cumsum(self.sizes[0][ids_a]), np.cumsum(self.sizes[1][ids_b])
        some = counts[0] > 0
        cut = shared_cuts(ends_a, ends_b, upto[0][some] - 1, upto[1][some] - 1)
        # a token's group: cuts before it
        group_a = np.cumsum(cut) - cut
        group_b = np.searchsorted(ends_a[cut], ends_b)
        last_b = np.append(group_b[1:] != group_b[:-1], True)[:len(group_b)]
        # in a row: A's tokens of a group, then B's
        row = np.empty(len(ids_a) + len(ids_b), dtype=object)
        row[np.arange(len(ids_a)) + np.searchsorted(group_b, group_a)] = self.shown[0][ids_a + cut * len(self.sizes[0])]
        row[np.arange(len(ids_b)) + np.searchsorted(group_a, group_b, side="right")] = self.shown[1][ids_b + last_b * len(self.sizes[1])]
        bounds = np.append(0, upto[0] + upto[1]).tolist()
        groups = [b"".join(row[x:y].tolist())[:-1] for x, y in zip(bounds, bounds[1:], strict=False)]
        a, b = overlaps(ends_a, ends_b)
        pairs = ids_a[a] << 32 | ids_b[b]
        edges = np.searchsorted(a, np.append(0, upto[0])).tolist()
        links = [pairs[x:y] for x, y in zip(edges, edges[1:], strict=False)]
        n_groups = np.diff(np.append(0, np.append(0, np.cumsum(cut))[upto[0]]))
        return Aligned(counts[0], counts[1], n_groups, groups, links)


class Aligned(NamedTuple):
    """By text: numbers of tokens of A and B and of groups, the groups as text, the links as pairs of ids."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    groups: list[bytes]
    links: list[np.ndarray]


@functools.cache
def load(path_a: str, path_b: str) -> Aligner:
    """The aligner of two files, built once in a process."""
    return Aligner(path_a, path_b)


def align(
    docs: DataFrame, path_a: str, path_b: str, *, text: str = "text", key: str = "doc_id", digest: bool = False,
) -> DataFrame:
    """``key``, n_a, n_b, n_groups, n_links, groups, and the distinct linked pairs of ids with their numbers.

    ``groups`` is text such as ``a1,a2|b1;a3|b2,b3``, or its SHA-256 if ``digest``
    (empty without tokens). A pair is A's id times 2**32, plus B's. The files lie
    on every machine.
    """
    source = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = source.schema["key"].dataType.simpleString()

    def lists(values: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
        offsets = np.cumsum([0, *map(len, values)])
        return pa.ListArray.from_arrays(
            pa.array(offsets, pa.int32()), pa.array(np.concatenate(values) if values else np.zeros(0, dtype=np.int64), kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = load(path_a, path_b)
        for batch, texts in blocks(batches, size=ALIGNED_BYTES):
            found = aligner.align(texts)
            pairs, times = zip(*(np.unique(x, return_counts=True) for x in found.links), strict=True)
            shown = [hashlib.sha256(g).hexdigest() if digest and g else g.decode() for g in found.groups]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *(pa.array(c, pa.int64()) for c in found[:3]),
                 pa.array([len(x) for x in found.links], pa.int64()),
                 pa.array(shown, pa.string()), lists(pairs, pa.int64()), lists(times, pa.int64())],
                names=["key", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"])

    return source.mapInArrow(
        run, f"key {kind}, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>",
    ).withColumnRenamed("key", key)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, count (links of it in the corpus), and best: whether no other pair of its B id has more."""
    each = aligned.select(F.inline(F.arrays_zip("pairs", "times")))
    counts = each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("count"))
    counts = stage(counts.withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))), "pair-counts")
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    return counts.join(highest, "b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def linked(
    docs: DataFrame, path_a: str, path_b: str, *, text: str = "text", key: str = "doc_id", digest: bool = True,
    broadcast_pairs: int = BROADCAST_PAIRS,
) -> DataFrame:
    """The columns of :func:`align` but for the lists, and n_best and count_sum over a document's links.

    Texts are aligned once: the pairs of each document are staged. A document's
    links are summed up in the task that reads them, before any shuffle, when the
    counts are broadcast.
    """
    aligned = align(docs, path_a, path_b, text=text, key=key, digest=digest)
    aligned = stage(aligned.withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = stage(pair_counts(aligned), "linked-pairs")
    counts = F.broadcast(counts) if counts.count() <= broadcast_pairs else counts
    each = aligned.select("row", F.inline(F.arrays_zip("pairs", "times")))
    sums = each.join(counts, F.col("pairs") == F.col("pair")).groupBy("row").agg(
        F.sum(F.col("times") * F.col("count")).alias("count_sum"),
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"))
    return aligned.drop("pairs", "times").join(sums, "row", "left").drop("row").withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in ("n_best", "count_sum")})
