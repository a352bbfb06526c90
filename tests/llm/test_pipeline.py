"""The corpus pipeline stage by stage, on planted cases and at the edges."""

from __future__ import annotations

import random
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from tallyward.sources.staging import stage, stage_root


def prose(rng, n):
    return " ".join("".join(rng.choice("aeioustrnlm") for _ in range(rng.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def planted(engine, tmp_path_factory):
    """Clean documents, copies, near copies, a shared passage, insults, and texts without letters."""
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(200):
        rows.append((i, prose(rng, 120)))
        labels.append((i, 0))
    for i in range(200, 260):
        words = prose(rng, 60).split()
        words[30] = "scoundrel"
        rows.append((i, " ".join(words)))
        if i < 250:
            labels.append((i, 1))
    for i in range(300, 320):
        rows.append((i, rows[i - 300][1]))
    for i in range(320, 340):
        words = rows[i - 320 + 40][1].split()
        words[60] = "changed"
        rows.append((i, " ".join(words)))
    shared = prose(rng, 60)
    rows += [(i, f"{prose(rng, 60)}\n{shared}\n{prose(rng, 60)}") for i in range(400, 410)]
    rows += [(500, "1234 !!"), (501, ""), (502, None)]
    folder = str(tmp_path_factory.mktemp("planted"))
    docs = engine.createDataFrame(rows, "doc_id long, text string").select(
        "*", F.lit("xx").alias("lang"), F.lit("s").alias("source"), F.char_length("text").cast("long").alias("n_chars"))
    docs.write.parquet(f"{folder}/documents.parquet")
    engine.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, dict(rows), shared


def test_planted_cases(engine, planted):
    folder, texts, shared = planted
    docs = engine.read.parquet(f"{folder}/documents.parquet")
    columns, ids = docs.columns, []
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(engine, docs, folder), name)
        if name != "packing":
            assert docs.columns == columns
        ids.append({r.doc_id for r in docs.select("doc_id").collect()})
        if name == "substring_dedup":
            cut = {r.doc_id: r for r in docs.collect()}
    language, toxic, near, substring, packed = ids
    assert language == set(texts) - {500, 501, 502}
    assert language - toxic == set(range(200, 260))
    assert toxic - near == set(range(300, 340))
    assert substring == near == packed
    for i in near:
        if 400 < i < 410:
            assert " ".join(shared.split()[20:40]) not in cut[i].text and cut[i].n_chars == len(cut[i].text)
        else:
            assert cut[i].text == texts[i]


def test_stages_take_extra_columns_and_edges(engine, planted, edge_docs, no_docs):
    folder = planted[0]
    for docs in (edge_docs, no_docs):
        for _, function in corpus_pipeline.STAGES[:-1]:
            found = function(engine, docs, folder)
            assert found.columns == docs.columns
            assert found.count() <= docs.count()
        assert function(engine, docs, folder) is not None
    kept = corpus_pipeline.near_dedup(engine, edge_docs, folder).collect()
    assert {r.doc_id for r in kept} >= {0, 4, None} and not {1, 5, 8} & {r.doc_id for r in kept}


def test_near_copies_are_told_apart_by_id_and_text(engine, planted):
    """Of equal rows one stays; of texts under one id only the copy goes; rows without an id stay."""
    rng = random.Random(5)
    a, b, c = (prose(rng, 80) for _ in range(3))
    rows = [(1, a), (2, b), (2, a), (3, c), (3, c), (3, c), (None, c), (None, c), (4, None), (4, None), (5, "")]
    docs = engine.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.char_length("text"))
    kept = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_dedup(engine, docs, planted[0]).collect()), key=str)
    assert kept == sorted([(1, a), (2, b), (3, c), (None, c), (None, c), (4, None)], key=str)


def test_stages_of_the_pipeline_are_released(engine, planted):
    """After a stage, what it keeps are its decisions; after the run, the last result only."""
    root = Path(stage_root(engine).removeprefix("file:"))
    docs = engine.read.parquet(f"{planted[0]}/documents.parquet")
    for function in (corpus_pipeline.near_dedup, corpus_pipeline.substring_dedup):
        before = {p.name for p in root.iterdir()}
        function(engine, docs, planted[0])
        left = {p.name.rsplit("-", 1)[0] for p in root.iterdir() if p.name not in before}
        assert left <= {"near-copies", "equal-rows", "chunks-places"}
    before = {p.name for p in root.iterdir()}
    found = corpus_pipeline.run(engine, planted[0])
    assert found.count() > 0
    assert {p.name.rsplit("-", 1)[0] for p in root.iterdir() if p.name not in before} == {"pipeline-packing"}


def test_stages_send_workers_small_batches_and_keep_a_session_s_own(engine, planted, no_docs):
    """Texts of 1 MB each: Spark's own bound lets 40 of them, and 64 MB in all, into one batch."""
    texts = engine.range(40, numPartitions=1).select(F.expr("repeat('word ', 200000)").alias("text"))

    def largest(batches):
        yield pa.RecordBatch.from_arrays([pa.array([max(b.nbytes for b in batches)])], names=["n"])

    def seen(function):
        function(engine, no_docs, planted[0])
        return texts.mapInArrow(largest, "n long").first().n

    for _, function in corpus_pipeline.STAGES:
        engine.conf.unset(corpus_pipeline.BATCH_KEY)
        assert seen(function) < 6 << 20
    engine.conf.set(corpus_pipeline.BATCH_KEY, "16m")
    try:
        assert 8 << 20 < seen(corpus_pipeline.sequences) < 18 << 20
    finally:
        engine.conf.unset(corpus_pipeline.BATCH_KEY)


def test_run_equals_the_stages(engine, sf_small):
    found = driver.queries()["pipeline"](engine, sf_small)
    assert found.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    assert found.count() > 0 and corpus_pipeline.ORACLE_SQL is None
    assert found.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0
