"""Near-duplicates by SimHash: exact comparison of fingerprints tile by tile.

A fingerprint sums the bits of the 64-bit hashes of a text's word shingles; wider
ones take several hashes of each shingle. Distinct fingerprints are laid in tiles
by the bit counts of the two halves of their first word; fingerprints whose counts
differ by more than the radius cannot be near, so only tiles within it meet. Tiles
are packed into bytes and sent by groups: a task takes the tiles of two groups and
compares the pairs between them, so a tile travels once for each group and not for
each tile. Two tiles are compared whole, by exclusive-or and bit counts, and give a forest of
their nearest links instead of all pairs: copies by the thousand cost no more rows
than fingerprints. Components join the forests.

With ``similarity``, fingerprints are of shingle sets, and equal sets, not equal
fingerprints, are one. Not all tiles meet then. Sets as similar as asked share one
of their first shingles, in any order that is the same for all; how many are first
follows from the similarity. So only the fingerprints of sets that meet at a first
shingle are compared. The order is by hash, but shingles at which many meet stand
last, and sets that meet at none but these are laid in tiles. No pair is lost by it.
Links are verified by the Jaccard similarity of the sets before they join anything,
those of tiles round after round until none between two components is left. Pairs
beyond the radius are never seen: sets of a few shingles may differ in more bits
than the radius at the similarity.

Defined results: NULL, empty and blank texts have fingerprint zero and are linked
like others; texts with fewer words than a shingle hash their whole sequence.
Equal texts, and repeated rows, share a component. Documents with a NULL id get
the least id that is not NULL, or NULL.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, pairwise, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import blocks, lower_bytes, record_batch, slices
from tallyward.llm.components import components
from tallyward.sources.staging import stage

SEED = 42
TILE = 8192
"""Fingerprints in a tile, about: 64 kB, and 0.1 s to compare two of them."""
GROUP, LEAST_GROUPS = 16, 8
"""Tiles in a group at most, about 6 MB at 256 bits; and groups to make, if there are tiles enough."""
ROWS_AT_ONCE = 128
MOST_LINKS = 1 << 20
MOST_MEET = 64
"""Sets that are compared at one shingle at most; it stands last if more meet there. Each pass takes twice as many."""
RANGE_ENTRIES = 1 << 19
"""First shingles that a task holds at once, about."""
ENTRIES_AT_ONCE, SETS_AT_ONCE = 1 << 15, 1024
ENTRY = np.dtype([("hash", np.uint64), ("node", np.uint64), ("word", np.uint64), ("previous", np.uint32)])
ODD = np.uint64(0x9E3779B97F4A7C15)


def shingles(words: list[bytes], size: int) -> list[bytes]:
    """Runs of ``size`` words joined by blanks, repeats included; all words if they are fewer."""
    if not words:
        return []
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    return [joined[a:b] for a, b in zip(starts, (ends[size - 1:] - 1).tolist() or [len(joined)], strict=False)]


def shingle_sets(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of each distinct shingle of each text, in the order of both."""
    words, ends, short = [], [], []
    for i, text in enumerate(texts):
        own = lower_bytes(text).split()
        if 0 < len(own) < size:
            short.append((i, xxhash.xxh3_64_intdigest(b" ".join(own))))
            own = []
        words += own
        ends.append(len(words))
    number: dict[bytes, int] = dict.fromkeys(words)
    for i, w in enumerate(number):
        number[w] = i
    digests = np.fromiter(map(xxhash.xxh3_64_intdigest, number), dtype=np.uint64, count=len(number))
    tokens = digests[np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))]
    lengths = np.diff(np.array(ends, dtype=np.int64), prepend=0)
    starts = max(0, len(tokens) - size + 1)
    hashes = np.zeros(starts, dtype=np.uint64)
    for k in range(size):
        hashes = hashes * ODD + tokens[k:k + starts]
    for shift in (30, 27, 31):
        hashes = (hashes ^ (hashes >> np.uint64(shift))) * ODD
    of = np.repeat(np.arange(len(texts)), lengths)
    whole = of[:starts] == of[size - 1:]
    of, hashes = of[:starts][whole], hashes[whole]
    if short:
        at = np.searchsorted(of, [i for i, _ in short])
        of, hashes = np.insert(of, at, [i for i, _ in short]), np.insert(hashes, at, np.array([h for _, h in short], dtype=np.uint64))
    ends = np.searchsorted(of, np.arange(len(texts) + 1)).tolist()
    for lo, hi in pairwise(ends):
        hashes[lo:hi].sort()
    new = np.append(True, (of[1:] != of[:-1]) | (hashes[1:] != hashes[:-1]))[:len(of)]
    return of[new], hashes[new]


def set_nodes(count: int, of: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The hash that names each of ``count`` sets of :func:`shingle_sets`."""
    ends = np.searchsorted(of, np.arange(count + 1)).tolist()
    raw = hashes.tobytes()
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(raw[8 * lo:8 * hi]) for lo, hi in pairwise(ends)], dtype=np.uint64).view(np.int64)


def fingerprint(text: str, size: int, words: int = 1) -> np.ndarray:
    """Unsigned words: each bit is set that more than half of the shingle hashes have."""
    return hashed(shingles(lower_bytes(text).split(), size), words)


def hashed(parts: list[bytes], words: int) -> np.ndarray:
    if not parts:
        return np.zeros(words, dtype=np.uint64)
    found = []
    for seed in range(SEED, SEED + words):
        digests = np.frombuffer(b"".join(map(xxhash.xxh64_digest, parts, repeat(seed))), dtype=np.uint8)
        # bytes are added up as bytes, 255 bits at most
        some = np.add.reduceat(np.unpackbits(digests.reshape(-1, 8), axis=1), np.arange(0, len(parts), 255), axis=0, dtype=np.uint8)
        found.append(np.packbits(2 * some.sum(axis=0, dtype=np.int64) > len(parts)).view(">u8")[0])
    return np.array(found, dtype=np.uint64)


def fingerprints(
    docs: DataFrame, *, text: str = "text", key: str = "doc_id", size: int = 4, words: int = 1, sets: bool = False,
    similarity: float = 0.0,
) -> DataFrame:
    """doc_id, text_hash, fp (64 bits to a long) and node, a long that names the fingerprint, of each whole text.

    The node of a one-word fingerprint is that word, of a wider one its hash. With
    ``sets``, each shingle of a text counts once, the node names their set, n is their
    number and first holds the least of their hashes, as :func:`leading` has them for
    ``similarity``.
    """
    source = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), text_hash(text).alias("text_hash"))
    types = "doc_id long, text_hash long, fp array<long>, node long"
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.list_(pa.int64())), ("node", pa.int64())])
    if sets:
        types, schema = f"{types}, n long, first binary", schema.append(pa.field("n", pa.int64())).append(pa.field("first", pa.binary()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches):
            if sets:
                of, hashes = shingle_sets(texts, size)
                found = [hashed(list(set(shingles(lower_bytes(t).split(), size))), words).view(np.int64) for t in texts]
                n = np.bincount(of, minlength=len(texts))
                yield record_batch(schema, [
                    batch.column("doc_id"), batch.column("text_hash"), found, set_nodes(len(texts), of, hashes), n,
                    leading(of, hashes, n, similarity)])
                continue
            found = [fingerprint(t, size, words).view(np.int64) for t in texts]
            nodes = [f[0] for f in found] if words == 1 else [
                np.uint64(xxhash.xxh3_64_intdigest(f.tobytes())).view(np.int64) for f in found]
            yield record_batch(schema, [batch.column("doc_id"), batch.column("text_hash"), found, np.array(nodes, dtype=np.int64)])

    return source.mapInArrow(run, types)


def text_hash(text: str) -> Column:
    """Tells apart the texts of rows with one id; NULL is its own."""
    return F.xxhash64(F.col(text).cast("string"))


def roots(a: np.ndarray, b: np.ndarray, root: np.ndarray) -> np.ndarray:
    """``root``, each node's least known companion, after the links a-b."""
    while len(a):
        ra, rb = root[a], root[b]
        differ = ra != rb
        if not differ.any():
            break
        a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
    return root


def spanning(count: int, a: np.ndarray, b: np.ndarray, apart: np.ndarray, joined: np.ndarray | None = None) -> np.ndarray:
    """Numbers of the links of a forest of least distances: each tree takes its nearest link, until none is left.

    ``joined``: each node's least companion among those that are already together.
    """
    order = np.argsort(apart, kind="stable")
    root, chosen = np.arange(count) if joined is None else joined.copy(), []
    while len(order):
        ra, rb = root[a[order]], root[b[order]]
        differ = ra != rb
        order, ra, rb = order[differ], ra[differ], rb[differ]
        if not len(order):
            break
        first = np.full(count, len(order))
        place = np.arange(len(order))
        np.minimum.at(first, ra, place)
        np.minimum.at(first, rb, place)
        picked = order[np.unique(first[first < len(order)])]
        chosen.append(picked)
        root = roots(a[picked], b[picked], root)
    return np.concatenate(chosen) if chosen else np.zeros(0, dtype=np.int64)


def forest(
    left: np.ndarray, right: np.ndarray | None, radius: int, first_radius: int, joined: np.ndarray | None = None,
    refused: np.ndarray | None = None, forests: int = 1,
) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs (a, b) that span all links within ``radius``; b counts on from the left tile's rows.

    Tiles are rows of words; pairs whose first words differ in more than
    ``first_radius`` bits are passed over, as are those of rows that are ``joined``
    (each row's least companion) and those ``refused`` (sorted: a * all rows + b).
    ``forests`` of them share no link.
    """
    other, shift = (left, 0) if right is None else (right, len(left))
    count = len(left) + (0 if right is None else len(right))
    a, b, d = (np.zeros(0, dtype=kind) for kind in (np.int32, np.int32, np.int16))
    held: list[tuple] = []
    for start in range(0, len(left), ROWS_AT_ONCE):
        rows = left[start:start + ROWS_AT_ONCE]
        first = start if right is None else 0
        apart = np.bitwise_count(rows[:, None, 0] ^ other[None, first:, 0])
        i, j = np.nonzero(apart <= first_radius)
        apart = apart[i, j].astype(np.int64)
        for word in range(1, left.shape[1]):
            apart += np.bitwise_count(rows[i, word] ^ other[first + j, word])
        near = (apart <= radius) & ((right is not None) | (i + start < j + first))
        i, j, apart = i[near] + start, j[near] + first + shift, apart[near]
        if joined is not None:
            open_ = joined[i] != joined[j]
            i, j, apart = i[open_], j[open_], apart[open_]
        if refused is not None and len(refused):
            keys = i * count + j
            open_ = refused[np.minimum(np.searchsorted(refused, keys), len(refused) - 1)] != keys
            i, j, apart = i[open_], j[open_], apart[open_]
        held.append((i.astype(np.int32), j.astype(np.int32), apart.astype(np.int16)))
        if sum(len(h[0]) for h in held) > MOST_LINKS or start + ROWS_AT_ONCE >= len(left):
            a, b, d = (np.concatenate([x, *(h[k] for h in held)]) for k, x in enumerate((a, b, d)))
            rest, kept = np.arange(len(a)), []
            for _ in range(forests):
                if not len(rest):
                    break
                kept.append(rest[spanning(count, a[rest], b[rest], d[rest], joined)])
                rest = np.setdiff1d(rest, kept[-1], assume_unique=True)
            kept = np.concatenate([np.zeros(0, dtype=np.int64), *kept])
            a, b, d, held = a[kept], b[kept], d[kept], []
    return a, b


def links(distinct: DataFrame, radius: int, first_radius: int | None = None, tile: int = TILE) -> DataFrame:
    """u and v: links among distinct fingerprints (fp, node) that span their components."""
    members, pairs, count = tiled(distinct, radius, first_radius, tile)
    return compared(members, pairs, count, radius, first_radius).select("u", "v")


def tiled(distinct: DataFrame, radius: int, first_radius: int | None, tile: int) -> tuple[DataFrame, DataFrame, int]:
    """The tile of each fingerprint, the pairs of tiles (a, b) that may hold near ones, and the number of tiles."""
    spark = distinct.sparkSession
    reach = radius if first_radius is None else first_radius
    # cells of the counts of both halves; wide radii take wide cells, or all would meet all
    step = max(1, reach - 3)
    word = F.element_at("fp", 1)
    high = F.bit_count(F.shiftrightunsigned(word, 32)).cast("int")
    low = F.bit_count(word.bitwiseAND(F.lit((1 << 32) - 1))).cast("int")
    placed = distinct.select(
        "fp", "node", F.floor(high / step).cast("int").alias("hi"), F.floor(low / step).cast("int").alias("lo"))
    # at most 33 x 33 cells, whatever the number of fingerprints
    cells = sorted((r["hi"], r["lo"], -(-r["n"] // tile)) for r in placed.groupBy("hi", "lo").agg(F.count("*").alias("n")).collect())
    ends = np.cumsum([0, *(tiles for _, _, tiles in cells)]).tolist()
    sizes = spark.createDataFrame(
        [(hi, lo, first, tiles) for (hi, lo, tiles), first in zip(cells, ends, strict=False)], "hi int, lo int, first long, tiles int")
    numbered = placed.join(F.broadcast(sizes), ["hi", "lo"])
    members = stage(numbered.select(
        "node", "fp", "hi", "lo", (F.col("first") + F.pmod(F.xxhash64("node"), F.col("tiles"))).alias("tile")), "simhash-members")
    tiles = members.select("tile", "hi", "lo").distinct()

    def least(cells_apart: int) -> int:
        return max(0, abs(cells_apart) * step - (step - 1))

    span = range(-33, 34)
    steps = [(dh, dl) for dh in span for dl in span if least(dh) + least(dl) <= reach]
    near = F.explode(F.array(*(F.struct(F.lit(dh).alias("dh"), F.lit(dl).alias("dl")) for dh, dl in steps)))
    around = tiles.select(F.col("tile").alias("a"), "hi", "lo", near.alias("step")).select(
        "a", (F.col("hi") + F.col("step.dh")).alias("hi"), (F.col("lo") + F.col("step.dl")).alias("lo"))
    pairs = around.join(F.broadcast(sizes), ["hi", "lo"]).select(
        "a", F.explode(F.sequence("first", F.col("first") + F.col("tiles") - 1)).alias("b")).where("a <= b")
    return members.select("tile", "node", "fp"), pairs, ends[-1]


def packed_tiles(members: DataFrame) -> DataFrame:
    """tile, nodes, fps and roots: a row of bytes for each tile, from rows of tile, node, fp and root."""
    schema = pa.schema([("tile", pa.int64()), ("nodes", pa.binary()), ("fps", pa.binary()), ("roots", pa.binary())])

    def pack(rows: pa.Table) -> pa.Table:
        whole = rows.combine_chunks()
        columns = [whole.column("node"), whole.column("fp").combine_chunks().flatten(), whole.column("root")]
        return pa.table([[whole.column("tile")[0].as_py()], *([c.to_numpy().tobytes()] for c in columns)], schema=schema)

    return members.select("tile", "node", "fp", "root").groupBy("tile").applyInArrow(
        pack, "tile long, nodes binary, fps binary, roots binary")


def dealt(tiles: DataFrame, pairs: DataFrame, count: int) -> DataFrame:
    """The rows that tasks compare, by ``cell``, a pair of groups: first its tiles (kind 0), then its pairs (kind 1).

    ``pairs``: a, b, and ``gone``, links (u, v) between the two that count no more.
    """
    size = max(1, min(GROUP, -(-count // LEAST_GROUPS)))
    groups = -(-count // size)
    asked = pairs.withColumn("cell", F.floor(F.col("a") / size) * max(1, groups) + F.floor(F.col("b") / size))
    wanted = asked.select("cell", F.col("a").alias("tile")).unionByName(asked.select("cell", F.col("b").alias("tile"))).distinct()
    zero, none = F.lit(0).cast("long"), F.lit(None)
    first = wanted.join(tiles, "tile").select(
        "cell", F.lit(0).alias("kind"), F.col("tile").alias("a"), zero.alias("b"), "nodes", "fps", "roots",
        none.cast(pairs.schema["gone"].dataType).alias("gone"))
    then = asked.select("cell", F.lit(1).alias("kind"), "a", "b", *(none.cast("binary").alias(c) for c in ("nodes", "fps", "roots")), "gone")
    return first.unionByName(then).repartition(max(1, groups * (groups + 1) // 2), "cell").sortWithinPartitions("cell", "kind", "a", "b")


def compared(
    members: DataFrame, pairs: DataFrame, count: int, radius: int, first_radius: int | None = None, roots: DataFrame | None = None,
    refused: DataFrame | None = None, forests: int = 1,
) -> DataFrame:
    """a, b, u and v: the tiles and nodes of links that span what is near and not yet together.

    ``roots``: node and root of those that are together with others; ``refused``: a,
    b, u and v of links that count no more. ``count``: the number of tiles.
    """
    reach = radius if first_radius is None else first_radius
    root, gone = F.col("node"), F.lit(None).cast("array<struct<u:long,v:long>>").alias("gone")
    if roots is not None:
        members, root = members.join(roots, "node", "left"), F.coalesce("root", "node")
    if refused is not None:
        lists = refused.groupBy("a", "b").agg(F.collect_list(F.struct("u", "v")).alias("gone"))
        pairs, gone = pairs.join(lists, ["a", "b"], "left"), F.col("gone")
    tiles = stage(packed_tiles(members.withColumn("root", root)), "simhash-tiles")

    def links_of(tile: tuple, other: tuple | None, gone: pa.ListScalar) -> tuple[np.ndarray, np.ndarray]:
        nodes, left, root = tile
        right = None
        if other is not None:
            nodes, right, root = np.concatenate([nodes, other[0]]), other[1], np.concatenate([root, other[2]])
        _, at, of = np.unique(root, return_index=True, return_inverse=True)
        least = np.full(len(at), len(nodes))
        np.minimum.at(least, of, np.arange(len(nodes)))
        bars = None
        if gone.is_valid:
            order = np.argsort(nodes)
            x, y = (order[np.searchsorted(nodes, gone.values.field(z).to_numpy(), sorter=order)] for z in ("u", "v"))
            bars = np.unique(np.minimum(x, y) * len(nodes) + np.maximum(x, y))
        a, b = forest(left, right, radius, reach, least[of], bars, forests)
        return nodes[a], nodes[b]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, {}
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("cell", "kind", "a", "b")), strict=True)
            for i, (cell, kind, first, second) in enumerate(rows):
                if cell != now:
                    now, held = cell, {}
                if kind == 0:
                    nodes, fps, root = (np.frombuffer(batch.column(c)[i].as_py(), dtype=np.int64) for c in ("nodes", "fps", "roots"))
                    held[first] = nodes, fps.view(np.uint64).reshape(len(nodes), -1), root
                elif first in held and second in held:  # tiles may be empty
                    u, v = links_of(held[first], held[second] if first != second else None, batch.column("gone")[i])
                    if len(u):
                        ends = [pa.array(np.full(len(u), x)) for x in (first, second)]
                        yield pa.RecordBatch.from_arrays([*ends, pa.array(u), pa.array(v)], names=["a", "b", "u", "v"])

    return dealt(tiles, pairs.select("a", "b", gone), count).mapInArrow(compare, "a long, b long, u long, v long")


def texts_of(nodes: DataFrame, distinct: DataFrame, docs: DataFrame, text: str, key: str) -> DataFrame:
    """node and text of the documents that may be what the nodes name: others with their ids may be among them."""
    wanted = distinct.join(nodes, "node", "left_semi").select("node", F.col("least").alias("doc_id"))
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.join(wanted, "doc_id").select("node", "text")


def node_sets(nodes: DataFrame, distinct: DataFrame, docs: DataFrame, size: int, text: str, key: str) -> DataFrame:
    """node and set, 32 bits of the hash of each shingle."""
    schema = pa.schema([("node", pa.int64()), ("set", pa.list_(pa.int32())), ("own", pa.int64())])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, values in blocks(batches):
            of, hashes = shingle_sets(values, size)
            own = set_nodes(len(values), of, hashes)
            # 32 bits of hash: in sets of thousands, collisions change no similarity to speak of
            parts = np.split(hashes.astype(np.uint32), np.searchsorted(of, np.arange(1, len(values))))
            yield record_batch(schema, [batch.column("node"), [np.unique(x).view(np.int32) for x in parts], own])

    # of several texts with one id, only those that the node names
    found = texts_of(nodes, distinct, docs, text, key).mapInArrow(sets, "node long, set array<int>, own long")
    return stage(found.where("node = own").drop("own").dropDuplicates(["node"]), "simhash-sets")


def verified(found: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The links whose nodes' sets are as similar as asked."""
    both = found.join(sets.withColumnsRenamed({"node": "u", "set": "one"}), "u").join(
        sets.withColumnsRenamed({"node": "v", "set": "two"}), "v")
    common = F.size(F.array_intersect("one", "two"))
    union = F.size("one") + F.size("two") - common
    return both.where((union == 0) | (common >= F.lit(similarity) * union)).select("u", "v")


def first_count(sizes: np.ndarray, similarity: float) -> np.ndarray:
    """How many shingles of a set are first: one more than may be missing from a set as similar as asked."""
    return np.where(sizes > 0, sizes - np.ceil(similarity * sizes - 1e-9).astype(np.int64) + 1, 0)


def leading(of: np.ndarray, hashes: np.ndarray, sizes: np.ndarray, similarity: float) -> list[bytes]:
    """The first shingles of each set by hash, and a quarter more, should some of them go last."""
    ends = np.cumsum(sizes)
    take = first_count(sizes, similarity)
    raw = hashes.tobytes()
    return [raw[8 * lo:8 * hi] for lo, hi in zip(
        (ends - sizes).tolist(), np.minimum(ends, ends - sizes + take + take // 4 + 4).tolist(), strict=True)]


@dataclass
class Leads:
    """The least hashes of some sets, of each set in order, when those of ``last`` (sorted) stand last."""

    of: np.ndarray
    hashes: np.ndarray
    sizes: np.ndarray
    take: np.ndarray
    last: np.ndarray

    @classmethod
    def read(cls, batch: pa.RecordBatch, similarity: float, last: np.ndarray) -> Leads:
        sizes, raw = batch.column("n").to_numpy(), batch.column("first").to_pylist()
        of = np.repeat(np.arange(len(raw)), [len(x) // 8 for x in raw])
        return cls(of, np.frombuffer(b"".join(raw), dtype=np.uint64), sizes, first_count(sizes, similarity), last)

    def __post_init__(self) -> None:
        self.free = ~within(self.last, self.hashes)
        self.n_free = np.bincount(self.of[self.free], minlength=len(self.sizes))
        counts = np.bincount(self.of, minlength=len(self.sizes))
        before = np.cumsum(self.free) - self.free
        starts = np.cumsum(counts) - counts
        if len(self.of):
            before -= before[np.minimum(starts, len(self.of) - 1)][self.of]
        self.first = self.free & (before < self.take[self.of])
        self.whole = counts == self.sizes
        self.told = self.whole | (self.n_free >= self.take)
        """Of these sets, all first shingles are known."""


def within(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(values), dtype=bool)
    return sorted_values[np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)] == values


def meetings(
    leads: DataFrame, *, similarity: float, reach: int, ranges: int, most: int, last: np.ndarray, before: np.ndarray | None,
) -> DataFrame:
    """kind, u and v: what comes of sets that meet at their first shingles, from rows of node, word, n and first.

    Kind 0 are links u-v of sets whose first words differ in ``reach`` bits at most,
    kind 1 shingles u at which more than ``most`` meet, and kind 2 sets u that have
    one of ``last`` among their first. ``last`` are the shingles known to be met by
    many, which stand last in the order and are not met at; ``before`` were those of
    the pass before, if any: sets that none of ``last`` was first in are done. Rows
    that do not tell the first shingles are passed over.
    """
    shared = leads.sparkSession.sparkContext.broadcast((last, before))
    names = ["range", "entries", "many", "open"]

    def in_ranges(values: np.ndarray, key: np.ndarray) -> dict[int, bytes]:
        part = ((key & np.uint64(0xFFFFFFFF)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        values, starts = values[order], np.flatnonzero(np.diff(part[order], prepend=-1)).tolist()
        return {int(part[order[lo]]): values[lo:hi].tobytes() for lo, hi in pairwise([*starts, len(order)])}

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, before = shared.value
        for batch in slices(batches, SETS_AT_ONCE):
            now = Leads.read(batch, similarity, last)
            nodes, words = (batch.column(c).to_numpy().view(np.uint64) for c in ("node", "word"))
            # of texts with one set, one is sent
            chosen, told = np.zeros(len(nodes), dtype=bool), np.flatnonzero(now.told)
            chosen[told[np.unique(nodes[told], return_index=True)[1]]] = True
            page = np.zeros(len(nodes), dtype=bool)
            if before is not None:
                was = Leads(now.of, now.hashes, now.sizes, now.take, before)
                kept = np.bincount(now.of[was.first & now.free], minlength=len(nodes))
                chosen &= kept < now.take
                # what is mostly a page that many have shows all its shingles, or each pass would find a few
                page = now.whole & (2 * kept < now.take)
            rows = (now.first | (page[now.of] & now.free)) & chosen[now.of]
            of, hashes = now.of[rows], now.hashes[rows]
            waiting = nodes[chosen & (now.n_free < now.take)]
            previous = np.where(np.diff(of, prepend=-1) == 0, np.roll(hashes, 1), np.uint64(0))
            found, at, n = np.unique(hashes, return_inverse=True, return_counts=True)
            many, few = found[n > most], (n <= most)[at]
            entries = np.empty(int(few.sum()), dtype=ENTRY)
            for name, column in (("hash", hashes), ("node", nodes[of]), ("word", words[of]), ("previous", previous.astype(np.uint32))):
                entries[name] = column[few]
            parts = in_ranges(entries, entries["hash"]), in_ranges(many, many), in_ranges(waiting, waiting)
            keys = sorted(set().union(*parts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int32()), *(pa.array([d.get(k) for k in keys], pa.binary()) for d in parts)], names=names)

    def merged(entries: list[np.ndarray], many: list[np.ndarray], least: int = 1) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Entries by shingle and node, each once, and the shingles that too many meet at, without their entries.

        Shingles of fewer entries than ``least`` are left out.
        """
        rows = np.concatenate([np.zeros(0, dtype=ENTRY), *entries])
        hashes = rows["hash"]
        order = np.argsort(hashes)
        lengths = np.diff(np.append(np.flatnonzero(np.diff(hashes[order], prepend=~hashes[order[:1]])), len(order)))
        rows = rows[order[np.repeat(lengths >= least, lengths)]]
        gone = np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *many]))
        rows = rows[~within(gone, rows["hash"])]
        rows = rows[np.lexsort((rows["node"], rows["hash"]))]
        rows = rows[np.append(True, (rows["hash"][1:] != rows["hash"][:-1]) | (rows["node"][1:] != rows["node"][:-1]))[:len(rows)]]
        found, at, n = np.unique(rows["hash"], return_inverse=True, return_counts=True)
        return [rows[(n <= most)[at]]], [np.concatenate([gone, found[n > most]])]

    def links_of(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nodes u < v that are near by their first words and did not meet at the shingle before already."""
        hashes, nodes, words, previous = (np.ascontiguousarray(rows[c]) for c in ENTRY.names)
        ends = np.searchsorted(hashes, hashes, side="right")
        at, held = np.arange(len(rows)), [np.zeros((0, 2), dtype=np.int64)]
        for gap in range(1, most):
            at = at[at + gap < ends[at]]
            if not len(at):
                break
            near = at[np.bitwise_count(words[at] ^ words[at + gap]) <= reach]
            near = near[(previous[near] != previous[near + gap]) | (previous[near] == 0)]
            held.append(np.stack([nodes[near], nodes[near + gap]], axis=1).view(np.int64))
        pairs = np.unique(np.sort(np.concatenate(held), axis=1), axis=0)
        return pairs[:, 0], pairs[:, 1]

    def done(entries: list[np.ndarray], many: list[np.ndarray], waiting: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        (rows,), (many,) = merged(entries, many, 2)
        waiting = np.unique(np.concatenate([many[:0], *waiting]))
        found = [(1, many.view(np.int64), np.zeros(len(many), dtype=np.int64)), (2, waiting.view(np.int64), np.zeros(len(waiting), dtype=np.int64))]
        # at most so many entries at once, whole shingles
        part = np.searchsorted(rows["hash"], rows["hash"]) // ENTRIES_AT_ONCE
        cuts = np.flatnonzero(np.diff(part)) + 1
        for kind, u, v in chain(found, ((0, *links_of(x)) for x in np.split(rows, cuts))):
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(u), kind, dtype=np.int8)), pa.array(np.ascontiguousarray(u)), pa.array(np.ascontiguousarray(v))],
                names=["kind", "u", "v"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, fresh = None, ([], [], []), 0
        for batch in batches:
            keys = batch.column("range").to_pylist()
            for i, key in enumerate(keys):
                if key != now:
                    if now is not None:
                        yield from done(*held)
                    now, held, fresh = key, ([], [], []), 0
                for values, name in zip(held, names[1:], strict=True):
                    if batch.column(name)[i].is_valid:
                        values.append(np.frombuffer(batch.column(name)[i].as_py(), dtype=ENTRY if name == "entries" else np.uint64))
                        fresh += len(values[-1])
                if fresh > 2 * RANGE_ENTRIES:
                    entries, many = merged(held[0], held[1])
                    held, fresh = (entries, many, held[2]), 0
        if now is not None:
            yield from done(*held)

    sent = leads.mapInArrow(send, "range int, entries binary, many binary, open binary")
    return sent.repartition(ranges, "range").sortWithinPartitions("range").mapInArrow(meet, "kind tinyint, u long, v long")


def whole_leads(
    leads: DataFrame, distinct: DataFrame, docs: DataFrame, similarity: float, size: int, text: str, key: str, last: np.ndarray,
) -> DataFrame:
    """The rows of ``leads`` that do not tell the first shingles of their sets, with all shingles, from the texts."""
    shared = leads.sparkSession.sparkContext.broadcast(last)

    def untold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SETS_AT_ONCE):
            told = Leads.read(batch, similarity, shared.value).told
            yield pa.RecordBatch.from_arrays([batch.column("node").filter(pa.array(~told))], names=["node"])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, values in blocks(batches):
            of, hashes = shingle_sets(values, size)
            ends = (8 * np.searchsorted(of, np.arange(len(values) + 1))).tolist()
            own, raw = set_nodes(len(values), of, hashes), hashes.tobytes()
            yield pa.RecordBatch.from_arrays([
                batch.column("node"), pa.array(np.bincount(of, minlength=len(values))),
                pa.array([raw[lo:hi] for lo, hi in pairwise(ends)], pa.binary()), pa.array(own)], names=["node", "n", "first", "own"])

    nodes = leads.mapInArrow(untold, "node long").distinct()
    found = texts_of(nodes, distinct, docs, text, key).mapInArrow(sets, "node long, n long, first binary, own long").where("node = own")
    words = distinct.select("node", F.element_at("fp", 1).alias("word"))
    return stage(found.join(words, "node").select("node", "word", "n", "first"), "simhash-whole")


def met(
    prints: DataFrame, distinct: DataFrame, docs: DataFrame, similarity: float, size: int, text: str, key: str, reach: int,
) -> tuple[DataFrame, DataFrame]:
    """u and v: links of sets that share a first shingle; and node: the sets that may have others, among themselves.

    In passes: shingles that too many meet at go last, and the sets that had them
    first meet again, until there is no such shingle. They are held by the driver and
    each task: at most one for ``MOST_MEET`` first shingles, and few in prose.
    """
    total = distinct.agg(F.sum("n").alias("all"), F.count("*").alias("sets")).first()
    ranges = max(1, math.ceil(((total["all"] or 0) * (1 - similarity) + total["sets"]) / RANGE_ENTRIES))
    leads = prints.select("node", F.element_at("fp", 1).alias("word"), "n", "first")
    asked, found, most, before, last = leads, None, MOST_MEET, None, np.zeros(0, dtype=np.uint64)
    while True:
        rows = stage(meetings(
            asked, similarity=similarity, reach=reach, ranges=ranges, most=most, last=last, before=before), "simhash-met")
        links = rows.where("kind = 0").select("u", "v")
        found = links if found is None else found.unionByName(links)
        many = rows.where("kind = 1").select("u").toPandas()["u"].to_numpy(dtype=np.int64).view(np.uint64)
        if not len(many):
            return found.distinct(), rows.where("kind = 2").select(F.col("u").alias("node")).distinct()
        before, last, most = last, np.union1d(last, many), 2 * most
        asked = leads.unionByName(whole_leads(leads, distinct, docs, similarity, size, text, key, last))


def within_radius(found: DataFrame, distinct: DataFrame, radius: int, reach: int) -> DataFrame:
    """The links whose fingerprints are near."""
    fps = distinct.select("node", "fp")
    both = found.join(fps.withColumnsRenamed({"node": "u", "fp": "one"}), "u").join(
        fps.withColumnsRenamed({"node": "v", "fp": "two"}), "v")
    apart = F.zip_with("one", "two", lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("int"))
    near = (F.element_at(apart, 1) <= reach) & (F.aggregate(apart, F.lit(0), lambda n, x: n + x) <= radius)
    return both.where(near).select("u", "v")


def verified_components(
    prints: DataFrame, distinct: DataFrame, docs: DataFrame, similarity: float, size: int, text: str, key: str, radius: int,
    first_radius: int | None, tile: int,
) -> DataFrame:
    """node and root over the links that are near and as similar as asked.

    All links of sets that meet at a first shingle are verified. Those of sets that
    only meet where many do are found in tiles, in rounds: the links of forests are
    verified, what passes is joined, what fails is refused, and tiles that gave links
    are compared again, until no link is left between two components. Each round
    takes four times as many forests as the last, so that many refused links are few
    rounds.
    """
    reach = radius if first_radius is None else first_radius
    found, rest = met(prints, distinct, docs, similarity, size, text, key, reach)
    near = stage(within_radius(found, distinct, radius, reach), "simhash-near")
    ends = near.select(F.col("u").alias("node")).unionByName(near.select(F.col("v").alias("node"))).distinct()
    passed = stage(verified(near, node_sets(ends, distinct, docs, size, text, key), similarity), "simhash-verified")
    joined = stage(components(passed, "simhash-components"), "simhash-joined")
    rest = stage(distinct.join(rest, "node", "left_semi"), "simhash-rest")
    if rest.isEmpty():
        return joined
    sets = node_sets(rest.select("node"), rest, docs, size, text, key)
    members, pairs, count = tiled(rest, radius, first_radius, tile)
    refused, forests = None, 1
    while True:
        found = stage(compared(members, pairs, count, radius, first_radius, joined, refused, forests), "simhash-links")
        if found.isEmpty():
            return joined
        asked = found.select("u", "v").distinct()
        good = stage(verified(asked, sets, similarity), "simhash-verified")
        failed = found.join(good, ["u", "v"], "left_anti").select("a", "b", "u", "v")
        refused = stage(failed if refused is None else refused.unionByName(failed), "simhash-refused")
        passed = passed.unionByName(good)
        joined = stage(components(passed, "simhash-components"), "simhash-joined")
        pairs, forests = found.select("a", "b").distinct(), forests * 4


def near_duplicates(
    docs: DataFrame, *, text: str = "text", key: str = "doc_id", size: int = 4, radius: int = 4, words: int = 1,
    first_radius: int | None = None, similarity: float | None = None, tile: int = TILE,
) -> DataFrame:
    """doc_id, text_hash, fp, node and component_id, the least doc_id reachable over links, of each document."""
    exact = similarity is not None
    prints = stage(fingerprints(docs, text=text, key=key, size=size, words=words, sets=exact, similarity=similarity or 0.0), "simhash-prints")
    sizes = [F.max("n").alias("n")] if exact else []
    distinct = stage(prints.groupBy("node").agg(F.min("fp").alias("fp"), F.min("doc_id").alias("least"), *sizes), "simhash-distinct")
    if not exact:
        joined = components(links(distinct, radius, first_radius, tile), "simhash-components")
    else:
        joined = verified_components(prints, distinct, docs, similarity, size, text, key, radius, first_radius, tile)
    rooted = stage(distinct.join(joined, "node", "left").select(
        "node", "least", F.coalesce("root", "node").alias("root")), "simhash-roots")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = stage(rooted.join(least, "root").select("node", "component_id"), "simhash-classes")
    return prints.join(classes, "node").select("doc_id", "text_hash", "fp", "node", "component_id")


def copies(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """doc_id and text_hash of the rows of :func:`near_duplicates` that go, and of those that stand there several times.

    Of each component the row with the least id stays, and of several texts under
    that id the one with the least hash. Rows with a NULL id, which nothing tells
    apart, are in neither.
    """
    rows = found.where("doc_id IS NOT NULL").select("doc_id", "text_hash", "component_id")
    first = rows.where("doc_id = component_id").groupBy("doc_id").agg(F.min("text_hash").alias("least"), F.max("text_hash").alias("most"))
    others = rows.where("doc_id = component_id").join(first.where("least <> most"), "doc_id").where("text_hash <> least")
    gone = rows.where("doc_id <> component_id").select("doc_id", "text_hash").unionByName(others.select("doc_id", "text_hash"))
    again = rows.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).where("n > 1").select("doc_id", "text_hash")
    return gone.distinct(), again
