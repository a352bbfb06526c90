"""Prefix trie of conversations with subtree totals by centroid decomposition.

Each distinct beginning of a conversation, its first d turns, is a node. A turn is
known by a digest of role and text; a beginning by the exclusive-or of hashes of
(digest, place), so that prefixes are running aggregates and a very long
conversation is cut into blocks of places.

The rollup splits the forest of parent edges at centroids. A component is known by
its top. Its centroid is the deepest node that holds half of the component's
weight; the nodes below it become components of their own, one for each child,
and their total is added to the centroid and, with the centroid's, to every node
on the path from there up to the top. Weights are turns of all members, which
shrink along such paths as parts are split off, so each round halves every
component. Components of more than ``local_nodes`` nodes are split by Spark, all
of them at once; ancestors are looked up in the path of a node's least member. The
others are finished inside a task, which splits by numbers of nodes.

Defined results: rows with a NULL conversation id take no part; NULL roles and
texts are empty; NULL turns come first, equal turns in the order of their digests;
repeated rows are turns of their own. An empty table has no nodes. Other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.sources.staging import stage

LOCAL_NODES = 1 << 16
BLOCK_TURNS = 1 << 12
NODE, PARENT, TOP = ["n1", "n2"], ["p1", "p2"], ["t1", "t2"]
"""The two halves of the keys of a node, its parent and its component's top."""


def ordered_turns(
    conversations: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """conv, place (from 1), mark (a digest of role and text) and chars of each turn.

    Rows are sorted by ranges, so that a conversation with a large share of all
    rows lies in many tasks; places are counted in each and shifted by what lies
    before.
    """
    role_, text_ = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    digest = F.sha2(F.concat(F.octet_length(role_).cast("string"), F.lit(":"), role_, text_), 256)
    turns = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"),
        F.unhex(F.substring(digest, 1, 32)).alias("mark"), F.char_length(text_).cast("long").alias("chars"),
        F.monotonically_increasing_id().alias("row"))
    order = ["turn", "mark", "row"]
    dealt = stage(turns.repartitionByRange("conv", *order).withColumn("part", F.spark_partition_id()), "turns")
    by_part = dealt.groupBy("conv", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = stage(by_part.select("conv", "part", F.sum("n").over(before).alias("shift")).where("shift IS NOT NULL"), "shifts")
    local = F.row_number().over(Window.partitionBy("part", "conv").orderBy(*order))
    placed = dealt.withColumn("local", local).join(shifts, ["conv", "part"], "left")
    return placed.select("conv", (F.col("local") + F.coalesce("shift", F.lit(0))).alias("place"), "mark", "chars")


def branched(turns: DataFrame, width: int = 100, most: int = 6) -> DataFrame:
    """Conversations whose first turns are those of the first of their ``width`` ids.

    Conversation c begins with the first h turns of c - c % width, where h is the
    crc32 of c written as text, modulo ``most``, and goes on with its own turns
    after its first h. Returns conv, total (its turns), place, mark and chars, with
    a row of place 0 for each conversation.
    """
    turns = stage(turns, "placed")
    heads = turns.where((F.col("conv") % width == 0) & (F.col("place") < most)).select(
        F.col("conv").alias("base"), F.col("place"), "mark", "chars")
    lengths = heads.groupBy("base").agg(F.count("*").alias("held"))
    shared = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    convs = turns.groupBy("conv").agg(F.max("place").alias("own")).withColumns(
        {"shared": shared, "base": F.col("conv") - F.col("conv") % width})
    taken = F.least("shared", F.coalesce("held", F.lit(0)))
    total = F.col("taken") + F.greatest(F.col("own") - F.col("shared"), F.lit(0))
    convs = stage(convs.join(lengths, "base", "left").withColumn("taken", taken).withColumn("total", total), "convs")
    own = turns.join(convs.select("conv", "total", "shared", "taken"), "conv").where("place > shared").select(
        "conv", "total", (F.col("place") - F.col("shared") + F.col("taken")).alias("place"), "mark", "chars")
    first = convs.select("conv", "total", "base", "taken").join(heads, "base").where("place <= taken").select(
        "conv", "total", "place", "mark", "chars")
    return own.unionByName(first).unionByName(_roots(convs))


def plain(turns: DataFrame) -> DataFrame:
    """The conversations as they are, in the form of :func:`branched`."""
    turns = stage(turns, "placed")
    convs = turns.groupBy("conv").agg(F.max("place").alias("total"))
    return turns.join(convs, "conv").select("conv", "total", "place", "mark", "chars").unionByName(_roots(convs))


def _roots(convs: DataFrame) -> DataFrame:
    return convs.select(
        "conv", "total", F.lit(0).cast("long").alias("place"), F.lit(None).cast("binary").alias("mark"),
        F.lit(0).cast("long").alias("chars"))


def paths_of(turns: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """conv, total, place, chars and the keys of node and parent for every beginning of every conversation."""
    own = [F.when(F.col("place") > 0, F.xxhash64(F.lit(salt), "mark", "place")).otherwise(F.lit(0)) for salt in (1, 2)]
    turns = stage(turns.select(
        "conv", "total", "place", "chars", F.floor(F.col("place") / block_turns).alias("block"),
        own[0].alias("x1"), own[1].alias("x2")), "keyed")
    blocks = turns.where(F.col("total") >= block_turns).groupBy("conv", "block").agg(
        F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"))
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = stage(blocks.select("conv", "block", *(F.bit_xor(f"x{i}").over(earlier).alias(f"s{i}") for i in (1, 2))), "blocks")
    upto = Window.partitionBy("conv", "block").orderBy("place")
    keys = {f"n{i}": F.col(f"l{i}").bitwiseXOR(F.coalesce(f"s{i}", F.lit(0))) for i in (1, 2)}
    found = turns.withColumns({f"l{i}": F.bit_xor(f"x{i}").over(upto) for i in (1, 2)})
    found = found.join(shifts, ["conv", "block"], "left").withColumns(keys)
    above = [F.when(F.col("place") > 0, F.col(f"n{i}").bitwiseXOR(F.col(f"x{i}"))).alias(f"p{i}") for i in (1, 2)]
    return found.select("conv", "total", "place", "chars", *NODE, *above)


def nodes_of(paths: DataFrame) -> DataFrame:
    """One row per node: least member, depth, parent, members, weight, and what is rolled up (leaf, saved).

    All nodes are in one component, the root's, and nothing has been added to them yet.
    """
    found = paths.groupBy(*NODE).agg(
        F.min("conv").alias("conv"), F.min("place").alias("depth"), F.count("*").alias("n_convs"),
        F.min("chars").alias("chars"), F.max("total").alias("reach"),
        F.sum(F.col("total") - F.col("place") + 1).alias("weight"), *(F.min(p).alias(p) for p in PARENT))
    return found.select(
        *NODE, *PARENT, "conv", "depth", "n_convs", "weight", (F.col("reach") == F.col("depth")).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
        *(F.lit(0).cast("long").alias(c) for c in (*TOP, "add_leaf", "add_saved")))


def _same(left: list[str], right: list[str]) -> Column:
    return (F.col(left[0]) == F.col(right[0])) & (F.col(left[1]) == F.col(right[1]))


def split_large(nodes: DataFrame, paths: DataFrame, local_nodes: int = LOCAL_NODES) -> DataFrame:
    """The nodes with their component's top, and what the splits of large components add (add_leaf, add_saved).

    A centroid ends as a component of its own.
    """
    live, ready = nodes, []
    while True:
        large = stage(live.groupBy(*TOP).agg(
            F.count("*").alias("n"), F.max("weight").alias("whole"), F.min("depth").alias("top_depth")).where(
            F.col("n") > local_nodes), "components")
        if large.isEmpty():
            break
        ready.append(stage(live.join(large, TOP, "left_anti"), "ready"))
        live = _split(live.join(large.drop("n"), TOP), paths)
    for part in ready:
        live = live.unionByName(part)
    return live


def _split(live: DataFrame, paths: DataFrame) -> DataFrame:
    """One round: every component in ``live`` loses its centroid."""
    live = stage(live, "live")
    half = live.where("2 * weight >= whole")  # a path from the top
    deepest = half.groupBy(*TOP).agg(F.max("depth").alias("depth"))
    half = half.join(deepest, [*TOP, "depth"], "left_semi")
    centroids = stage(half.select(
        *TOP, "top_depth", F.col("n1").alias("c1"), F.col("n2").alias("c2"), F.col("conv").alias("c_conv"),
        F.col("depth").alias("c_depth"), F.col("weight").alias("c_weight"), F.col("leaf").alias("c_leaf"),
        F.col("saved").alias("c_saved")), "centroids")
    live = live.drop("whole", "top_depth").join(centroids, TOP)
    # the child of the centroid that a deeper node is under, if any
    steps = paths.select(
        F.col("conv"), F.col("place").alias("step"), F.col("n1").alias("k1"), F.col("n2").alias("k2"),
        F.col("p1").alias("q1"), F.col("p2").alias("q2"))
    deeper = live.where("depth > c_depth").withColumn("step", F.col("c_depth") + 1).join(steps, ["conv", "step"])
    under = _same(["q1", "q2"], ["c1", "c2"])
    looked = stage(deeper.withColumn("under", under).select(
        *live.columns, "under", *(F.when(F.col("under"), F.col(f"k{i}")).otherwise(F.col(f"t{i}")).alias(f"new{i}") for i in (1, 2))
    ).unionByName(live.where("depth <= c_depth").withColumns(
        {"under": F.lit(False), "new1": F.col("t1"), "new2": F.col("t2")})), "looked")
    below = looked.where("under").groupBy(*TOP).agg(F.sum("leaf").alias("b_leaf"), F.sum("saved").alias("b_saved"))
    totals = stage(centroids.join(below, TOP, "left").withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in ("b_leaf", "b_saved")}), "totals")
    # from the centroid to the top: the centroid gets what is below it, the others the centroid's own as well
    on_path = totals.join(paths.select(F.col("conv").alias("c_conv"), "place", *NODE), "c_conv").where(
        "place BETWEEN top_depth AND c_depth").select(
        *NODE, (F.col("place") == F.col("c_depth")).alias("is_centroid"), F.col("c_weight").alias("less"),
        *((F.col(f"b_{v}") + F.when(F.col("place") < F.col("c_depth"), F.col(f"c_{v}")).otherwise(0)).alias(f"more_{v}")
          for v in ("leaf", "saved")))
    moved = looked.join(on_path, NODE, "left").withColumns({
        "is_centroid": F.coalesce("is_centroid", F.lit(False)),
        "weight": F.col("weight") - F.coalesce("less", F.lit(0)),
        **{f"add_{v}": F.col(f"add_{v}") + F.coalesce(f"more_{v}", F.lit(0)) for v in ("leaf", "saved")}})
    alone = {f"t{i}": F.when(F.col("is_centroid"), F.col(f"n{i}")).otherwise(F.col(f"new{i}")) for i in (1, 2)}
    # a centroid that was its component's top leaves no node behind under its name
    return stage(moved.withColumns(alone).select(
        *NODE, *PARENT, "conv", "depth", "n_convs", "weight", "leaf", "saved", *TOP, "add_leaf", "add_saved"), "split")


def rolled(parents: list[int], starts: list[int], values: list[list[int]]) -> list[list[int]]:
    """Subtree sums of each value by centroid decomposition.

    Nodes come component by component, each from its top in ``starts`` on, parents
    before children, with the parent's place in ``parents`` unless a node is a top.
    """
    count = len(parents)
    sums = [list(v) for v in values]
    size = [0] * count
    group = [0] * count  # the list a node goes to: 0 above the centroid
    stack = [list(range(a, b)) for a, b in zip(starts, [*starts[1:], count], strict=True)]
    while stack:
        part = stack.pop()
        if len(part) < 2:
            continue
        for v in part:
            size[v] = 1
            group[v] = 0
        for v in part[:0:-1]:
            size[parents[v]] += size[v]
        centroid = next(v for v in reversed(part) if 2 * size[v] >= len(part))
        lists: list[list[int]] = [[]]
        for v in part:
            if v == centroid:
                continue
            if v != part[0] and parents[v] == centroid:
                group[v] = len(lists)
                lists.append([v])
            else:
                group[v] = group[parents[v]] if v != part[0] else 0
                lists[group[v]].append(v)
        for own, total in zip(values, sums, strict=True):
            below = sum(own[v] for members in lists[1:] for v in members)
            total[centroid] += below
            at = centroid
            while at != part[0]:
                at = parents[at]
                total[at] += below + own[centroid]
        stack += lists
    return sums


def _whole_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches that end where the keys change; rows with equal keys must follow one another."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        last = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0))
        begins = [c[0] for c in columns]
        if held and any(h.column(k)[-1].as_py() != b for h, k, b in zip([held[-1]] * len(keys), keys, begins, strict=True)):
            yield pa.concat_batches(held)
            held = []
        if len(last):
            cut = int(last[-1]) + 1
            yield pa.concat_batches([*held, batch.slice(0, cut)])
            held = []
            batch = batch.slice(cut)
        held.append(batch)
    if held:
        yield pa.concat_batches(held)


def finish(components: DataFrame) -> DataFrame:
    """n_leaves and saved_tokens of each node; a task holds whole components, one after another."""
    kept = [*NODE, *PARENT, "conv", "depth", "n_convs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_runs(batches, TOP):
            keys = list(zip(*(batch.column(c).to_pylist() for c in NODE), strict=True))
            tops = list(zip(*(batch.column(c).to_pylist() for c in TOP), strict=True))
            above = zip(*(batch.column(c).to_pylist() for c in PARENT), strict=True)
            place = {key: i for i, key in enumerate(keys)}
            starts = [i for i, top in enumerate(tops) if not i or top != tops[i - 1]]
            own = set(starts)
            parents = [-1 if i in own else place[p] for i, p in enumerate(above)]
            values = [batch.column(c).to_pylist() for c in ("leaf", "saved")]
            found = rolled(parents, starts, values)
            more = [batch.column(f"add_{c}").to_pylist() for c in ("leaf", "saved")]
            totals = [pa.array([a + b for a, b in zip(f, m, strict=True)], pa.int64()) for f, m in zip(found, more, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *totals], names=[*kept, "n_leaves", "saved_tokens"])

    dealt = components.repartition(*TOP).sortWithinPartitions(*TOP, "depth")
    own = ", ".join(f"{c} long" for c in kept)
    return dealt.select(*kept, *TOP, "leaf", "saved", "add_leaf", "add_saved").mapInArrow(
        run, f"{own}, n_leaves long, saved_tokens long")


def ends_of(paths: DataFrame) -> DataFrame:
    """n1, n2 and ends_sha256 of the nodes where conversations end.

    Ids are sorted by ranges and written as pieces of text, so that a node where
    very many end is dealt over tasks; its digest is then fed piece by piece.
    """
    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b, ids = (batch.column(c).to_numpy() for c in (*NODE, "conv"))
            first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
            pieces = [",".join(map(str, ids[x:y].tolist())) for x, y in zip(first, np.append(first[1:], len(ids)), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[first]), pa.array(b[first]), pa.array(ids[first]), pa.array(pieces)], names=[*NODE, "first", "ids"])

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            rows = zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids")), strict=True)
            for a, b, ids in rows:
                if (a, b) != node:
                    if state:
                        done.append((*node, state.hexdigest()))
                    node, state = (a, b), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _digests(done)
        if state:
            yield _digests([(*node, state.hexdigest())])

    ends = paths.where("place = total").select(*NODE, "conv")
    pieces = ends.repartitionByRange(*NODE, "conv").sortWithinPartitions(*NODE, "conv").mapInArrow(
        written, "n1 long, n2 long, first long, ids string")
    return pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(
        digested, "n1 long, n2 long, ends_sha256 string")


def _digests(done: list[tuple[int, int, str]]) -> pa.RecordBatch:
    a, b, c = (list(x) for x in zip(*done, strict=True)) if done else ([], [], [])
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.string())], names=[*NODE, "ends_sha256"])


def trie(turns: DataFrame, *, local_nodes: int = LOCAL_NODES, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row per node of the conversations of :func:`branched` or :func:`plain`.

    conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.
    """
    paths = stage(paths_of(turns, block_turns), "paths")
    nodes = stage(nodes_of(paths), "nodes")
    totals = stage(finish(split_large(nodes, paths, local_nodes)), "totals")
    children = nodes.where("depth > 0").groupBy(*PARENT).agg(F.count("*").alias("n_children")).withColumnsRenamed(
        dict(zip(PARENT, NODE, strict=True)))
    parents = nodes.select(F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("conv").alias("parent_conv_id"))
    found = totals.join(children, NODE, "left").join(ends_of(paths), NODE, "left")
    return found.join(parents, PARENT, "left").select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
