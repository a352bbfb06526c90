"""License notices in running text, found in spite of small errors.

A notice that may differ in ``k`` characters is split into ``k + 1`` seeds: one of
them must occur exactly (pigeonhole). An Aho-Corasick automaton finds the seeds
in one pass over the text's words; around each, the bounded-error matching of the
``regex`` library verifies the notice and reports where it stands.

Words are runs of digits, letters and all characters beyond ASCII, with A-Z in
lower case; notices are matched on the words joined by single blanks, at word
borders. Defined results: NULL is read as the empty text, which has no words and
no notice. Overlapping places of a phrase all count. Repeated rows get repeated
results; other columns are not read. The work grows with the text and with what is
found in it: words are counted on from place to place.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import blocks, lower_bytes, record_batch

WORDS = re.compile(rb"[0-9a-z\x80-\xff]+").findall

BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
"""Fixed values: phrases that count only as they stand."""

NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "permission is hereby granted free of charge to any person": "mit",
    "released under the mit license": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "reserved",
    "general public license": "gpl",
}
"""Notices that are matched with errors, and their labels."""

LETTERS_PER_ERROR = 9
MOST_ERRORS = 3


@dataclass(frozen=True)
class Match:
    label: str
    first_word: int
    words: int
    errors: int


class NoticeFinder:
    """Seeds and patterns of a set of notices; phrases of ``exact`` take no errors."""

    def __init__(self, notices: dict[str, str] = NOTICES, exact: dict[str, str] = BASE_PHRASES) -> None:
        self.exact = {f" {p} ": (label, len(p.split())) for p, label in exact.items()}
        self.notices = []
        seeds: dict[str, list[tuple[int, int]]] = {}
        for number, (phrase, label) in enumerate(notices.items()):
            errors = min(MOST_ERRORS, len(phrase) // LETTERS_PER_ERROR)
            pattern = regex.compile(rf"(?b)(?<= )(?:{regex.escape(phrase)}){{e<={errors}}}(?= )")
            self.notices.append((phrase, label, errors, pattern))
            for start, end in self.cuts(len(phrase), errors + 1):
                seeds.setdefault(phrase[start:end], []).append((number, start))
        self.automaton = ahocorasick.Automaton()
        for seed, uses in seeds.items():
            self.automaton.add_word(seed, (len(seed), uses))
        self.automaton.make_automaton()

    @staticmethod
    def cuts(size: int, parts: int) -> list[tuple[int, int]]:
        edges = [round(i * size / parts) for i in range(parts + 1)]
        return list(zip(edges, edges[1:], strict=False))

    def base(self, joined: str) -> tuple[list[tuple[str, int, int]], list[int]]:
        """Places of exact phrases in blank-separated words: (label, first word, words)."""
        found = []
        for phrase, (label, words) in self.exact.items():
            place, counted = 0, 0
            at = joined.find(phrase)
            while at >= 0:
                place, counted = place + joined.count(" ", counted, at), at
                found.append((label, place, words))
                at = joined.find(phrase, at + 1)
        return found, sorted(f[1] for f in found)

    def fuzzy(self, joined: str) -> list[Match]:
        """Verified notices, each place once, with the fewest errors."""
        begins: dict[int, set[int]] = {}
        for end, (size, uses) in self.automaton.iter(joined):
            for number, offset in uses:
                begins.setdefault(number, set()).add(end + 1 - size - offset)
        spans: list[tuple[int, int, int, str]] = []
        for number, starts in begins.items():
            phrase, label, allowed, pattern = self.notices[number]
            framed = f" {phrase} "
            for start in starts:
                if start > 0 and joined.startswith(framed, start - 1):  # as it stands: nothing fits better
                    spans.append((start, start + len(phrase), 0, label))
                    continue
                match = pattern.search(joined, max(0, start - allowed - 1), min(len(joined), start + len(phrase) + allowed + 2))
                if match:
                    spans.append((match.start(), match.end(), sum(match.fuzzy_counts), label))
        found: dict[tuple[str, int], Match] = {}
        place, counted = -1, 0  # words before, counted on from place to place
        for start, end, errors, label in sorted(spans):
            place, counted = place + joined.count(" ", counted, start), start
            known = found.get((label, place))
            if known is None or errors < known.errors:
                found[label, place] = Match(label, place, joined.count(" ", start, end) + 1, errors)
        return sorted(found.values(), key=lambda m: (m.first_word, m.label))


def finder_of(notices: DataFrame, *, phrase: str = "phrase", label: str = "label", most: int = 10_000) -> NoticeFinder:
    """A finder for a table of notices, whose words are joined by single blanks; more than ``most`` are refused.

    A phrase without words, or without a label, is left out; of equal phrases the least label counts.
    """
    rows = notices.select(F.col(phrase).cast("string"), F.col(label).cast("string")).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} notices")
    own = sorted(((b" ".join(WORDS(lower_bytes(p))).decode("utf-8", "surrogatepass"), name) for p, name in rows if p and name), reverse=True)
    return NoticeFinder({p: name for p, name in own if p})


SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
    ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ("notices", pa.list_(pa.struct([
        ("label", pa.string()), ("first_word", pa.int64()), ("words", pa.int64()), ("errors", pa.int64()),
    ]))),
])


def scan(docs: DataFrame, *, text: str = "text", key: str = "doc_id", finder: NoticeFinder | None = None) -> DataFrame:
    """One row per document: base places, labels, notices with spans and errors, and a score.

    The score is that of the best notice: 1 without errors, less by the share of
    its allowed errors that it needed (half of it at most), and 0 without notices.
    """
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    given = finder and (
        {p: label for p, label, _, _ in finder.notices}, {p.strip(): v[0] for p, v in finder.exact.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = NoticeFinder(*given) if given else NoticeFinder()
        for batch, texts in blocks(batches):
            rows = []
            for value in texts:
                words = WORDS(lower_bytes(value))
                joined = (b" " + b" ".join(words) + b" ").decode("utf-8", "surrogatepass") if words else " "
                places, starts = own.base(joined)
                notices = own.fuzzy(joined)
                base_labels = sorted({p[0] for p in places})
                labels = sorted({*base_labels, *(m.label for m in notices)})
                best = min((m.errors for m in notices), default=None)
                score = 1.0 if places or best == 0 else 0.0 if best is None else 1 - best / (2 * MOST_ERRORS)
                rows.append((
                    len(words), len(places), starts[0] if starts else None, starts[-1] if starts else None,
                    ",".join(base_labels), ",".join(labels), score,
                    [{"label": m.label, "first_word": m.first_word, "words": m.words, "errors": m.errors} for m in notices],
                ))
            yield record_batch(SCHEMA, [batch.column("doc_id"), *map(list, zip(*rows, strict=True))])

    return source.mapInArrow(run, (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string,"
        " labels string, score double, notices array<struct<label string, first_word long, words long, errors long>>"
    ))
