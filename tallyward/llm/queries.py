"""The registered queries of the text operators, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tallyward.llm import alignment, bpe, chunks, decontamination, langid, lm, notices, packing, prefixtrie, rarity, simhash, topk, toxicity
from tallyward.llm.common import fold, table

Build = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Build] = {}
ORACLE_SQL: dict[str, str] = {}


def query(build: Build) -> Build:
    QUERIES[build.__name__] = build
    return build


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and the texts they decode to, as digests."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity, learned from the labelled documents of two folds in three."""
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 3) == 1
    model = toxicity.fit(docs.where(~held_out), table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"))


@query
def op4_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and n-gram scores, learned from the documents of six folds in seven."""
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 7) == 2
    found = lm.score(docs, lm.fit(docs.where(~held_out)))
    return found.withColumn("held_out", held_out)


@query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without passages that another document keeps."""
    found = chunks.deduplicate(table(spark, sf_dir, "documents"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "text", F.size("removed").alias("n_removed"), gone.alias("removed_bytes"))


@query
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact base phrases and notices with small errors."""
    return notices.scan(table(spark, sf_dir, "documents"))


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose fingerprints differ in 4 bits at most."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), size=4, radius=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("node")), 16, "0").alias("fingerprint"), "component_id")


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages, learned from the documents of three folds in four."""
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = langid.fit(docs.where(~held_out))
    return langid.identify(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 ids."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(table(spark, sf_dir, "documents"), path, with_ids=False)


@query
def op10_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of texts and edited texts, and how alike they and the next text's are."""
    return rarity.with_next(table(spark, sf_dir, "documents"))


@query
def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest inner products of each vector whose id is divisible by 20."""
    vectors = topk.integral(table(spark, sf_dir, "embeddings"), key="vec_id", vector="embedding", scale=64)
    return topk.search(vectors.where(F.col("vec_id") % 20 == 0), vectors, 20)


ORACLE_SQL["op1_topk_search"] = """
WITH valid AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x : floor(64 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
      AND len(list_filter(embedding, lambda x : x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM valid q, valid c WHERE q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@query
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of tokens between shared cuts of two tokenizers, and how common their links are."""
    path_a, path_b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.linked(table(spark, sf_dir, "documents"), path_a, path_b).withColumnRenamed("groups", "groups_sha256")


@query
def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents within windows of ten words that benchmark items hold."""
    found = decontamination.find(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLE_SQL["op12_decontamination"] = r"""
WITH doc_words AS (
    SELECT doc_id, row_number() OVER () AS doc, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), item_words AS (
    SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), item_places AS (
    SELECT item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS place FROM item_words WHERE len(words) > 0
), item_windows AS (
    SELECT DISTINCT item_id, array_to_string(words[place:place + 9], ' ') AS window_text, least(len(words), 10) AS size
    FROM item_places
), sizes AS (
    SELECT DISTINCT size FROM item_windows
), places AS (
    SELECT doc, words, size, unnest(range(1, len(words) - size + 2)) AS place FROM doc_words, sizes WHERE len(words) >= size
), hits AS (
    SELECT doc, place, p.size, item_id
    FROM places p JOIN item_windows w ON w.size = p.size AND array_to_string(words[place:place + p.size - 1], ' ') = window_text
), hit_words AS (
    SELECT doc, count(DISTINCT word) AS n_hit
    FROM (SELECT DISTINCT doc, unnest(range(place, place + size)) AS word FROM hits) GROUP BY doc
), hit_items AS (
    SELECT doc, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS listed
    FROM (SELECT DISTINCT doc, item_id FROM hits) GROUP BY doc
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit_words USING (doc) LEFT JOIN hit_items USING (doc)
"""


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of conversations that share beginnings, with subtree totals."""
    return prefixtrie.trie(prefixtrie.branched(prefixtrie.ordered_turns(table(spark, sf_dir, "conversations"))))


ORACLE_SQL["op13_prefix_trie"] = """
WITH own AS (
    SELECT conv_id, list(struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) ORDER BY turn NULLS FIRST) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), shares AS (
    SELECT conv_id, turns, xor(4294967295, list_reduce(
        list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c : CAST(ascii(c) AS BIGINT))),
        lambda crc, byte : list_reduce(
            list_prepend(xor(crc, byte), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
            lambda v, bit : CASE WHEN (v & 1) = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END))) % 6 AS shared
    FROM own
), rebuilt AS (
    SELECT s.conv_id, list_concat(coalesce(b.turns[1:s.shared], []), s.turns[s.shared + 1:]) AS turns
    FROM shares s LEFT JOIN own b ON b.conv_id = s.conv_id - s.conv_id % 100
), members AS (
    SELECT conv_id, depth, turns[1:depth] AS path, depth = len(turns) AS at_end
    FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt)
), nodes AS (
    SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        (count(*) - 1) * CASE WHEN depth = 0 THEN 0 ELSE length(path[depth].text) END AS saved,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE at_end), '')) AS ends_sha256
    FROM members GROUP BY path, depth
), children AS (
    SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), counted AS (
    SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children c ON n.path = c.path
), above AS (
    SELECT path[1:up] AS path, n_children, saved
    FROM (SELECT path, n_children, saved, unnest(range(0, depth + 1)) AS up FROM counted)
), totals AS (
    SELECT path, count(*) FILTER (WHERE n_children = 0) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
    FROM above GROUP BY path
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, t.n_leaves, t.saved_tokens, n.ends_sha256
FROM counted n JOIN totals t ON t.path = n.path
LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]
"""


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    return corpus_pipeline.run(spark, sf_dir)
