"""Registered queries of the corpus operators: op1 to op10 over their whole tables, and the pipeline."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from touchline.llm import ann, byte_bpe, chat, chunk_dedup, hard_negatives, langid, packing, quality, sharding, simhash, simhash_dedup, token_align, wrappers
from touchline.llm.common import blank, id_bucket, materialise, table

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# --- 5: chat formatting -------------------------------------------------------------------------

@query("op5_chat_formatting", r"""
    WITH rows AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
      UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
    esc AS (
      SELECT *, regexp_replace(role, '([<\[])(~*)(\||/?s>|/?INST\])', '\1~\2\3', 'g') AS erole,
             regexp_replace(text, '([<\[])(~*)(\||/?s>|/?INST\])', '\1~\2\3', 'g') AS etext FROM rows)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
           coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
           sum(length('<|turn|><|text|><|end|>') + length(erole) + length(etext))::BIGINT AS formatted_chars
    FROM esc GROUP BY conv_id""")
def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    log = chat.events_from_turns(stored.unionByName(chat.probe_conversation(spark, stored)))
    back = chat.read_back(chat.render(chat.reconstruct(log)))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", "n_turns", F.sha2(turns, 256).alias("turns_sha256"),
                       F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


# --- 6: sharding --------------------------------------------------------------------------------

@query("op6_byte_prefix_sharding")
def op6_byte_prefix_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = blank(F.col("text"))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("text_key"))
    out = sharding.balanced_shards(rows, "size", ["text_key", "text_crc32", "doc_id"], shards=16, group="text_key")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


# --- 2: best-fit packing ------------------------------------------------------------------------

@query("op2_best_fit_packing")
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


# --- 10: SimHash near-dedup ---------------------------------------------------------------------

@query("op10_simhash_near_dedup")
def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = simhash_dedup.near_duplicates(docs, distance=4, shingle=4)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# --- 7: language ID -----------------------------------------------------------------------------

@query("op7_rank_order_language_id")
def op7_rank_order_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_bucket(F.col("doc_id"), 3) == 1
    found = langid.profiles(docs.filter(~held_out).select("text", "lang"))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return langid.with_language(rows, found, keep=["doc_id", "held_out"])


# --- 1: quality classifier ----------------------------------------------------------------------

@query("op1_ftrl_quality")
def op1_ftrl_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(id_bucket(F.col("doc_id"), 4) != 2)
    weights = quality.train(quality.labelled_documents(docs, labels))
    rows = docs.withColumn("held_out", id_bucket(F.col("doc_id"), 4) == 2)
    return (quality.with_score(rows, weights, keep=["doc_id", "held_out"]).withColumn("predicted", (F.col("score") >= quality.THRESHOLD).cast("int"))
            .select("doc_id", "held_out", "score", "predicted"))


# --- 3: document fingerprints -------------------------------------------------------------------

@query("op3_simhash_fingerprints")
def op3_simhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``n_within_3``: for documents whose id is divisible by 100, how many documents (itself included) have
    a fingerprint within 3 bits, by the permuted block tables; null for the others."""
    prints = simhash.fingerprints_with_next(table(spark, sf_dir, "documents").select("doc_id", "text"))
    prints = materialise(prints, "fingerprints")
    asked = F.col("doc_id") % 100 == 0
    found = simhash.within_radius(prints.filter(asked), prints)
    sizes = prints.groupBy(F.col("fingerprint").alias("found")).agg(F.count("*").alias("rows"))
    counts = found.join(sizes, "found").groupBy("query").agg(F.sum("rows").alias("n_within_3"))
    searched = prints.filter(asked).join(counts, F.col("fingerprint") == F.col("query"), "left").drop("query")
    return searched.unionByName(prints.filter(~F.coalesce(asked, F.lit(False))).withColumn("n_within_3", F.lit(None).cast("long")))


# --- 9: byte-level BPE --------------------------------------------------------------------------

@query("op9_distinct_word_bpe")
def op9_distinct_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


# --- 8: approximate nearest neighbours ----------------------------------------------------------

@query("op8_inverted_multi_index")
def op8_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.search(vectors, F.col("vec_id") % 20 == 0, k=20)


# --- 4: HTML extraction -------------------------------------------------------------------------

@query("op4_wrapper_inference")
def op4_wrapper_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = wrappers.main_texts(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


# --- 11: hard-negative mining -------------------------------------------------------------------

@query("op11_anchor_list_negatives", """
    WITH v AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS c
      FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    pairs AS (
      SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id,
             list_sum(list_transform(range(1, len(a.c) + 1), lambda i: a.c[i] * b.c[i]))::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
    positives AS (
      SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN (SELECT * FROM pairs WHERE NOT same) USING (anchor_id)
    WHERE 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
    QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5""")
def op11_anchor_list_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), "embedding")
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)


# --- 12: cross-tokenizer alignment --------------------------------------------------------------

@query("op12_lockstep_alignment")
def op12_lockstep_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_align.digests(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


# --- 13: exact dedup ----------------------------------------------------------------------------

@query("op13_chunk_recipe_dedup", """
    WITH texts AS (
      SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
    SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
           doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
    FROM texts""")
def op13_chunk_recipe_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.exact_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


# --- pipeline -----------------------------------------------------------------------------------

query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
