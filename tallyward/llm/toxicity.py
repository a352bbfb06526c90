"""Toxic passages as maximum-scoring segments of token log-odds.

Each token weighs its log-odds of standing in toxic rather than clean documents,
under a Dirichlet prior from the pooled counts, less its own uncertainty. Beginnings
of tokens have log-odds too, since insults are inflected: a token weighs what the
strongest of its beginnings or itself does, and once within a segment: words
repeat, so their repetition tells little. Tokens without clear evidence weigh
slightly below zero. A linear scan finds all maximal
segments of positive weight. Their scores follow an extreme-value law in clean
text, whose scale comes from the token distribution of clean documents: a
segment counts by how far it exceeds what a clean text of that length would show.
A logistic curve, fitted on documents the weights were not learned from, turns
the sum over the significant segments into a probability.

Defined results: NULL, empty and wordless texts have no segments and get the
score of a text without evidence. With no labels of one of the two kinds the
score is the constant 0. Copies of a training text count once.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import blocks, draw_of, with_columns
from tallyward.sources.staging import stage

TOKENS = re.compile(r"[^\W\d_]+").findall
FLAT_PRIOR = 0.5
PRIOR_STRENGTH = 1000.0
DOUBT = 2.0
"""Standard errors that are taken off a token's log-odds."""
DRIFT = 0.5
"""What a token without evidence weighs below zero."""


SHORTEST, LONGEST = 4, 8
"""Letters of the beginnings that have log-odds of their own."""
MEMO_TOKENS = 200_000


def features(token: str) -> list[str]:
    """A token and its beginnings; the mark keeps whole tokens apart."""
    return [token + "$", *(token[:n] for n in range(SHORTEST, min(LONGEST, len(token)) + 1))]


def maximal_segments(weights: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring runs (start, end, score) of a sequence, in linear time.

    Keeps the candidates found so far with the sums before and after each; a new
    positive item joins the nearest candidate that starts lower, if that one ends
    no higher, and takes all between into one.
    """
    found: list[list] = []  # start, end, sum before, sum after, nearest earlier one that starts lower
    total = 0.0
    for place, weight in enumerate(weights):
        if weight <= 0:
            total += weight
            continue
        start, before, after = place, total, total + weight
        total = after
        while True:
            lower = len(found) - 1
            while lower >= 0 and found[lower][2] >= before:
                lower = found[lower][4]
            if lower < 0 or found[lower][3] >= after:
                found.append([start, place + 1, before, after, lower])
                break
            start, before = found[lower][0], found[lower][2]
            del found[lower:]
    return [(s, e, after - before) for s, e, before, after, _ in found]


@dataclass
class ToxicityModel:
    """Token weights, the extreme-value scale of clean text, and a logistic curve."""

    weights: dict[str, float]
    scale: float
    slope: float
    middle: float
    constant: float | None = None
    _memo: dict[str, float] = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_memo": {}}

    def _weight(self, token: str) -> float:
        weight = max((self.weights.get(f, -DRIFT) for f in features(token)), default=-DRIFT)
        if len(self._memo) >= MEMO_TOKENS:
            self._memo.clear()
        self._memo[token] = weight
        return weight

    def passages(self, text: str) -> tuple[int, list[tuple[int, int, float]]]:
        """The text's token count, and its significant segments with their excess.

        The excess of a segment with score s among n tokens is scale * s - ln n: the
        negative logarithm of the number of such segments in clean text.
        """
        tokens = TOKENS(text.lower())
        known = self._memo.get
        weights = [w if (w := known(t)) is not None else self._weight(t) for t in tokens]
        if max(weights, default=-1.0) <= 0:
            return len(tokens), []
        noise = math.log(len(tokens) + 1)
        found = []
        for start, end, score in maximal_segments(weights):
            if self.scale * score > noise:
                found += self._damped(tokens, weights, start, end, noise)
        return len(tokens), sorted(found)

    def _damped(self, tokens: list[str], weights: list[float], start: int, end: int, noise: float) -> list[tuple[int, int, float]]:
        """The significant segments within one, each token weighing once; if there are none, those within its parts.

        Parts lie on either side of the widest gap, of equal ones that nearest the middle.
        """
        found, open_ = [], [(start, end)]
        while open_:
            lo, hi = open_.pop()
            positive = [i for i in range(lo, hi) if weights[i] > 0]
            if self.scale * sum({tokens[i]: weights[i] for i in positive}.values()) <= noise:
                continue
            part, seen = weights[lo:hi], set()
            for i in positive:
                if tokens[i] in seen:
                    part[i - lo] = 0.0
                seen.add(tokens[i])
            kept = [(lo + s, lo + e, self.scale * score - noise) for s, e, score in maximal_segments(part)]
            kept = [f for f in kept if f[2] > 0]
            if kept or len(positive) < 2:
                found += kept
                continue
            gaps = list(zip(positive[:-1], positive[1:], strict=True))
            x, y = max(gaps, key=lambda g: (g[1] - g[0], -abs(g[0] + g[1] - lo - hi)))
            open_ += [(lo, x + 1), (y, hi)]
        return found

    def evidence(self, text: str) -> float:
        return math.log1p(sum(excess for _, _, excess in self.passages(text)[1]))

    def score(self, text: str) -> float:
        return self.calibrated(self.evidence(text))

    def calibrated(self, evidence: float) -> float:
        if self.constant is not None:
            return self.constant
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, self.slope * (evidence - self.middle)))))


def token_weights(counts: DataFrame) -> tuple[dict[str, float], float]:
    """Weights of features with evidence, and the scale of clean text.

    ``counts``: feature, and the toxic (a) and clean (b) documents it is in. Only
    features that weigh something come to the driver. The scale solves the sum of
    p(t) * exp(scale * w(t)) = 1 over what clean text holds.
    """
    sums = counts.agg(F.sum("a").alias("toxic"), F.sum("b").alias("clean"), F.count("*").alias("n")).first()
    toxic, clean = sums["toxic"] or 0, sums["clean"] or 0
    if not toxic or not clean:
        return {}, 1.0
    prior_sum = FLAT_PRIOR * sums["n"] + PRIOR_STRENGTH
    a, b = F.col("a"), F.col("b")
    prior = F.lit(FLAT_PRIOR) + (a + b) * (PRIOR_STRENGTH / (toxic + clean))
    odds_toxic = (a + prior) / (F.lit(toxic + prior_sum) - a - prior)
    odds_clean = (b + prior) / (F.lit(clean + prior_sum) - b - prior)
    sure = F.log(odds_toxic / odds_clean) - F.sqrt(1 / (a + prior) + 1 / (b + prior)) * DOUBT
    rows = counts.where("a > 0").withColumn("sure", sure).where("sure > 0").select("feature", "sure", "b").toPandas()
    weights = rows["sure"].to_numpy()
    share = (rows["b"].to_numpy() + FLAT_PRIOR) / (clean + prior_sum)
    rest = 1 - share.sum()
    low, high = 1e-3, 50.0
    for _ in range(60):
        middle = (low + high) / 2
        value = rest * math.exp(-DRIFT * middle) + (share * np.exp(np.minimum(700.0, weights * middle))).sum()
        low, high = (middle, high) if value < 1 else (low, middle)
    return dict(zip(rows["feature"], weights.tolist(), strict=True)), low


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and middle of P(y = 1), by Newton steps with a small ridge."""
    slope, offset = 1.0, 0.0
    design = np.stack([x, np.ones_like(x)])
    ridge = np.diag([1e-2, 1e-4])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -50, 50)))
        gradient = design @ (y - p) - ridge @ np.array([slope, offset])
        step = np.linalg.solve((design * (p * (1 - p) + 1e-9)) @ design.T + ridge, gradient)
        slope, offset = slope + float(np.clip(step[0], -5, 5)), offset + float(np.clip(step[1], -5, 5))
    slope = max(slope, 1e-3)
    return slope, -offset / slope


def fit(
    docs: DataFrame, labels: DataFrame, *, text: str = "text", key: str = "doc_id", label: str = "toxic",
    rows_per_label: int = 20_000, share_of_weights: float = 0.75,
) -> ToxicityModel:
    """Learn from the documents that ``labels`` marks 0 or 1.

    ``rows_per_label`` bounds the labels drawn of each kind (about; by a hash of the
    key), and with them the model and what is broadcast. Repeated labels are one,
    those without a key none. Copies of a text are one row, that with the least key.
    """
    marked = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("y")).where(
        "y IN (0, 1) AND key IS NOT NULL").distinct()
    sizes = {r["y"]: r["n"] for r in marked.groupBy("y").agg(F.count("*").alias("n")).collect()}
    share = F.when(F.col("y") == 1, min(1.0, rows_per_label / max(1, sizes.get(1, 0)))).otherwise(
        min(1.0, rows_per_label / max(1, sizes.get(0, 0))))
    drawn = marked.where(draw_of("key") < share)
    texts = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).where("text IS NOT NULL")
    # the labels drawn have a bound, so they go to the texts; no text is shuffled
    hashed = texts.join(F.broadcast(drawn), "key").select("key", "y", F.xxhash64("text").alias("hash"))
    single = stage(hashed.groupBy("hash").agg(F.min(F.struct("key", "y")).alias("row")).select(
        "row.key", "row.y", F.pmod("hash", F.lit(1000)).alias("draw")), "toxicity-rows")
    part = F.col("draw") < int(share_of_weights * 1000)

    def chosen(rows: DataFrame) -> DataFrame:
        return texts.join(F.broadcast(rows), "key").select("text", "y")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, values in blocks(batches):
            seen: tuple[Counter, Counter] = Counter(), Counter()
            for value, y in zip(values, batch.column("y").to_pylist(), strict=True):
                seen[y].update({f for t in set(TOKENS(value.lower())) for f in features(t)})
            found = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays([
                pa.array(found, pa.string()), pa.array([seen[1][f] for f in found], pa.int64()),
                pa.array([seen[0][f] for f in found], pa.int64()),
            ], names=["feature", "a", "b"])

    counts = stage(chosen(single.where(part)).mapInArrow(count, "feature string, a long, b long").groupBy("feature").agg(
        F.sum("a").alias("a"), F.sum("b").alias("b")), "toxicity-counts")
    weights, scale = token_weights(counts)
    model = ToxicityModel(weights, scale, 1.0, 0.0)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, values in blocks(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([shared.value.evidence(t) for t in values], pa.float64()), batch.column("y")], names=["x", "y"])

    held = chosen(single.where(~part)).mapInArrow(measure, "x double, y int").toPandas()
    if held["y"].nunique() < 2:  # too few rows to hold any back
        held = chosen(single).mapInArrow(measure, "x double, y int").toPandas()
    if held["y"].nunique() < 2:
        return ToxicityModel({}, 1.0, 1.0, 0.0, constant=0.0)
    model.slope, model.middle = logistic(held["x"].to_numpy(), held["y"].to_numpy(dtype=float))
    return model


def score(
    docs: DataFrame, model: ToxicityModel, *, text: str = "text", names: tuple[str, str] = ("score", "passages"),
) -> DataFrame:
    """``docs`` with the score and the significant passages (first token, tokens, excess) of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    passage = pa.struct([("first_token", pa.int64()), ("tokens", pa.int64()), ("excess", pa.float64())])
    fields = pa.schema([(names[0], pa.float64()), (names[1], pa.list_(passage))])

    def prepare() -> Callable[[str], tuple]:
        own = shared.value

        def of(value: str) -> tuple:
            found = own.passages(value)[1]
            return own.calibrated(math.log1p(sum(x for _, _, x in found))), [
                {"first_token": s, "tokens": e - s, "excess": x} for s, e, x in found]

        return of

    return with_columns(docs, text, prepare, fields, (
        f"`{names[0]}` double, `{names[1]}` array<struct<first_token:bigint,tokens:bigint,excess:double>>"))
