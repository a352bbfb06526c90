"""Language identification by words first, then ever shorter character n-grams.

A word that training has seen votes with its log frequency in each language. An
unseen word falls back to its character n-grams: the longest order of which any
n-gram is known decides, with the mean of the known ones.

Defined results: NULL, empty and letterless texts are ``und`` with score 0; with
nothing to learn from, every text is. Ties go to the language that sorts first.
Repeated rows get repeated results; other columns are not touched.

Every Python worker holds the model: its words and n-grams are arrays of hashes and
of text, and only the words met lately are Python objects.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import blocks, draw_of, record_batch, slices, with_columns

UNKNOWN = "und"
MARKS = "".join(c for c in map(chr, range(0x300, 0x20000)) if unicodedata.category(c)[0] == "M")
WORD = re.compile(rf"[^\W\d_]+(?:[{MARKS}]+[^\W\d_]*)*")
"""Letters and the marks that follow them, without which many scripts' words fall to pieces."""
LONGEST_GRAM = 5
MEMO_ROWS = 100_000
WORDS_AT_ONCE = 1000
"""Distinct words whose n-grams are counted together in a task."""
EVIDENCE = 20
"""Words of evidence that a score counts at most; more of them only average better."""


def grams(word: str, order: int) -> list[str]:
    marked = f"<{word}>"
    return [marked[i:i + order] for i in range(len(marked) - order + 1)]


@dataclass
class Names:
    """Distinct texts by their hashes, in a few arrays; a hit is compared in full."""

    hashes: np.ndarray
    starts: np.ndarray
    data: bytes

    @classmethod
    def of(cls, names: list[str]) -> tuple[Names, np.ndarray]:
        """The names, and the places in ``names`` of those numbered 0, 1, ..."""
        raw = [n.encode("utf-8", "surrogatepass") for n in names]
        hashes = cls._digests(raw)
        order = np.argsort(hashes, kind="stable")
        lengths = np.fromiter((len(raw[i]) for i in order), dtype=np.int64, count=len(raw))
        return cls(hashes[order], np.append(0, np.cumsum(lengths)), b"".join(raw[i] for i in order)), order

    @staticmethod
    def _digests(raw: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, raw), dtype=np.uint64, count=len(raw))

    def __len__(self) -> int:
        return len(self.hashes)

    def find(self, names: list[str]) -> np.ndarray:
        """The number of each name, -1 where absent."""
        raw = [n.encode("utf-8", "surrogatepass") for n in names]
        found = np.full(len(raw), -1, dtype=np.int64)
        if not len(self):
            return found
        hashes = self._digests(raw)
        first = np.searchsorted(self.hashes, hashes)
        hits = np.flatnonzero(self.hashes[np.minimum(first, len(self) - 1)] == hashes)
        first = first[hits]
        for i, at, lo, hi in zip(*(x.tolist() for x in (hits, first, self.starts[first], self.starts[first + 1])), strict=True):
            while self.data[lo:hi] != raw[i]:  # another name of the same hash
                at += 1
                if at == len(self) or self.hashes[at] != hashes[i]:
                    at = -1
                    break
                lo, hi = int(self.starts[at]), int(self.starts[at + 1])
            found[i] = at
        return found


@dataclass
class LanguageModel:
    """Log frequencies per language of words (order 0) and of n-grams by order."""

    languages: list[str]
    index: list[Names]
    logs: list[np.ndarray]
    _memo: dict[str, int] = field(default_factory=dict, repr=False)
    _rows: np.ndarray | None = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_memo": {}, "_rows": None}

    def _back_off(self, words: list[str]) -> np.ndarray:
        """Rows of unseen words, each by the longest order that knows any of its n-grams."""
        rows = np.zeros((len(words), len(self.languages)), dtype=np.float32)
        left = np.arange(len(words))
        for order in range(LONGEST_GRAM, 0, -1):
            parts = [grams(words[i], order) for i in left.tolist()]
            of = np.repeat(left, [len(part) for part in parts])
            found = self.index[order].find(list(chain.from_iterable(parts)))
            known = found >= 0
            np.add.at(rows, of[known], self.logs[order][found[known]])
            n = np.bincount(of[known], minlength=len(words))[left]
            rows[left] /= np.maximum(n, 1)[:, None].astype(np.float32)
            left = left[n == 0]
            if not len(left):
                break
        return rows

    def _remember(self, words: list[str]) -> None:
        """Rows for the words that have none; the memo starts anew when full."""
        memo = self._memo
        new = [w for w in words if w not in memo]
        if self._rows is None or len(memo) + len(new) > MEMO_ROWS:
            self._memo, new = {}, words
            self._rows = np.zeros((MEMO_ROWS, len(self.languages)), dtype=np.float32)
        if not new:
            return
        start, found = len(self._memo), self.index[0].find(new)
        known, unseen = np.flatnonzero(found >= 0), np.flatnonzero(found < 0)
        self._rows[start + known] = self.logs[0][found[known]]
        if len(unseen):
            self._rows[start + unseen] = self._back_off([new[i] for i in unseen.tolist()])
        self._memo.update(zip(new, range(start, start + len(new)), strict=True))

    def predict(self, text: str) -> tuple[str, float]:
        words = WORD.findall(text.lower())
        if not self.languages or not any(c.isalpha() for w in words for c in w):
            return UNKNOWN, 0.0
        counts = Counter(words)
        total = np.zeros(len(self.languages))
        distinct = list(counts)
        for lo in range(0, len(distinct), MEMO_ROWS // 2):
            part = distinct[lo:lo + MEMO_ROWS // 2]
            self._remember(part)
            rows = list(map(self._memo.__getitem__, part))
            weights = np.fromiter((counts[w] for w in part), dtype=np.float64, count=len(part))
            total += weights @ self._rows[rows]
        mean = total / len(words) * min(len(words), EVIDENCE)
        odds = np.exp(mean - mean.max())
        best = int(odds.argmax())
        return self.languages[best], float(odds[best] / odds.sum())


def fit(
    docs: DataFrame, *, text: str = "text", label: str = "lang", key: str = "doc_id", rows_per_language: int = 2000,
) -> LanguageModel:
    """Learn from rows with a label.

    One parameter bounds the model, whatever the size of the corpus: about
    ``rows_per_language`` labelled rows are read of each language, drawn by a hash
    of ``key`` and text. All words and n-grams of these rows count.
    """
    labelled = docs.select(
        F.col(text).cast("string").alias("text"), F.col(label).cast("string").alias("lang"), F.col(key).alias("key"),
    ).where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return LanguageModel([], [Names.of([])[0]] * (LONGEST_GRAM + 1), [np.zeros((0, 0))] * (LONGEST_GRAM + 1))
    share = F.create_map(*(F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, rows_per_language / n))))
    drawn = labelled.where(draw_of("key", "text") < share[F.col("lang")]).select("text", "lang")
    word_schema = pa.schema([("lang", pa.string()), ("gram", pa.string()), ("n", pa.int64())])
    gram_schema = pa.schema([("lang", pa.string()), ("gram_order", pa.int32()), ("gram", pa.string()), ("n", pa.int64())])

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches):
            words: dict[str, Counter] = {}
            for lang, value in zip(batch.column("lang").to_pylist(), texts, strict=True):
                words.setdefault(lang, Counter()).update(WORD.findall(value.lower()))
            for lang, seen in words.items():
                yield record_batch(word_schema, [[lang] * len(seen), list(seen), list(seen.values())])

    def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, WORDS_AT_ONCE):
            found: Counter = Counter()
            for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "gram", "n")), strict=True):
                found[lang, 0, word] += n
                for order in range(1, LONGEST_GRAM + 1):
                    for gram in grams(word, order):
                        found[lang, order, gram] += n
            columns = list(zip(*found, strict=True)) or [[], [], []]
            yield record_batch(gram_schema, [*map(list, columns), list(found.values())])

    # distinct words first: their n-grams are then found once, not once for each place
    words = drawn.mapInArrow(count_words, "lang string, gram string, n long").groupBy(
        "lang", "gram").agg(F.sum("n").alias("n"))
    counts = words.mapInArrow(count_grams, "lang string, gram_order int, gram string, n long").groupBy(
        "lang", "gram_order", "gram").agg(F.sum("n").alias("n"))
    found = counts.toArrow()
    languages = sorted(sizes)
    index, logs = [], []
    for order in range(LONGEST_GRAM + 1):
        part = found.filter(pc.equal(found["gram_order"], order))
        grams_here, column = pc.unique(part["gram"]), pc.index_in(part["lang"], pa.array(languages))
        grams_here = grams_here.take(pc.sort_indices(grams_here))
        names, places = Names.of(grams_here.to_pylist())
        table = np.zeros((len(names), len(languages)))
        table[pc.index_in(part["gram"], grams_here).to_numpy(), column.to_numpy()] = part["n"].to_numpy()
        totals = table.sum(axis=0) + 0.5 * len(names)
        index.append(names)
        logs.append(np.log((table + 0.5) / np.maximum(totals, 1)).astype(np.float32)[places])
    return LanguageModel(languages, index, logs)


def identify(
    docs: DataFrame, model: LanguageModel, *, text: str = "text", names: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """``docs`` with the language of each whole text and the score, under ``names``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = pa.schema([(names[0], pa.string()), (names[1], pa.float64())])
    return with_columns(docs, text, lambda: shared.value.predict, fields, f"`{names[0]}` string, `{names[1]}` double")
