"""The registered queries of the subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailflow.llm import (
    bpe,
    chat,
    embed_dedup,
    html_extract,
    id_files,
    langid,
    packing,
    quality,
    runs,
    simhash,
    spelling,
    topk,
    toxicity,
)
from retailflow.llm.common import fold, read
from retailflow.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.98."""
    return embed_dedup.link_embeddings(read(spark, sf_dir, "embeddings"))


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best rows of every fiftieth embedding."""
    return topk.top_k(read(spark, sf_dir, "embeddings"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = read(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.train(pages))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from the view of each of its participants."""
    return chat.rotate_dialogues(read(spark, sf_dir, "conversations"))


def _with_fold(scored: DataFrame, modulus: int, held_out: int, *columns: str) -> DataFrame:
    return scored.select("doc_id", (fold(F.col("doc_id"), modulus) == held_out).alias("held_out"), *columns)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned outside fold 2 of 4."""
    docs = read(spark, sf_dir, "documents")
    scored = langid.identify(docs, langid.train(docs, modulus=4, held_out=2))
    return _with_fold(scored, 4, 2, "lang_pred", "score")


def op6_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the byte-level BPE ids of every document and of their decoded text."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = bpe.encode_documents(read(spark, sf_dir, "documents"), path)
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned outside fold 1 of 3."""
    docs = read(spark, sf_dir, "documents")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), modulus=3, held_out=1)
    return _with_fold(toxicity.score_documents(docs, model), 3, 1, "score", "predicted")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces in sequences of at most 2048 tokens."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(read(spark, sf_dir, "documents"), path)


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash groups of all documents at two differing bits."""
    groups = simhash.simhash_groups(read(spark, sf_dir, "documents"), words=3, max_bits=2)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learned outside fold 0 of 5."""
    docs = read(spark, sf_dir, "documents")
    model = quality.train(docs, read(spark, sf_dir, "labels"), modulus=5, held_out=0)
    return _with_fold(quality.score_documents(docs, model), 5, 0, "score", "predicted")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the periodic runs of every document, every tenth with a periodic tail."""
    docs = read(spark, sf_dir, "documents")
    found = runs.run_documents(docs.select("doc_id", runs.plant_period(F.col("text"), F.col("doc_id")).alias("text")))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    first = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), -r["start"], -r["period"]))
    best = found.withColumn("best", F.array_max(first))
    best = best.withColumn("best", F.struct(F.col("best.length"), (-F.col("best.col2")).alias("start"), (-F.col("best.col3")).alias("period")))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(listed, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place and checksum of every document's ids, from the compressed files that hold them."""
    folder = scratch_path(spark, "llm-token-files")
    id_files.write_files(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), folder, end_id=2)
    return id_files.read_files(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents, some with a letter dropped, and the forms that they vary."""
    groups = spelling.variant_groups(read(spark, sf_dir, "documents"), drop_every=97)
    return groups.select("word", "form", "root", "n", "n_near", "form_n")


QUERIES: dict[str, Query] = {
    "op1_embedding_near_dedup": op1_embedding_near_dedup,
    "op2_exact_top_k": op2_exact_top_k,
    "op3_html_extraction": op3_html_extraction,
    "op4_chat_formatting": op4_chat_formatting,
    "op5_language_id": op5_language_id,
    "op6_bpe_encode_decode": op6_bpe_encode_decode,
    "op7_toxicity": op7_toxicity,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_token_files": op12_token_files,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLES: dict[str, str] = {
    "op1_embedding_near_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
reach(u, w) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.u, l.w FROM reach r JOIN links l ON l.u = r.w),
low AS (SELECT u, min(w) AS component_id FROM reach GROUP BY u),
n AS (SELECT u, count(*) AS n_links FROM links GROUP BY u)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN low ON low.u = vec_id LEFT JOIN n ON n.u = vec_id""",
    "op2_exact_top_k": """
WITH v AS (SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS x FROM embeddings),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5""",
    "op4_chat_formatting": r"""
WITH d AS (
  SELECT DISTINCT conv_id, turn, nullif(trim(role), '') AS role, replace(coalesce(text, ''), '<|', '< |') AS body
  FROM conversations WHERE conv_id IS NOT NULL),
m AS (
  SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, body) - 1) // 1024 AS part
  FROM d),
p AS (SELECT DISTINCT conv_id, role AS speaker FROM d WHERE role IS NOT NULL AND role <> 'system'),
r AS (
  SELECT p.speaker, m.*, role IS NOT DISTINCT FROM speaker AS own,
    CASE WHEN role = speaker THEN '<|start|>assistant' || chr(10) WHEN role = 'system' THEN '<|start|>system' || chr(10)
      ELSE '<|start|>user name=' || replace(replace(coalesce(role, 'unknown'), '<|', '< |'), chr(10), ' ') || chr(10) END AS head,
    body || '<|end|>' AS said
  FROM m JOIN p USING (conv_id)),
o AS (
  SELECT *, row_number() OVER w AS n, sum(length(head) + length(said) + 1) OVER w - length(said) - 1 AS pos
  FROM r WINDOW w AS (PARTITION BY conv_id, part, speaker ORDER BY turn NULLS FIRST, role NULLS FIRST, body
    ROWS UNBOUNDED PRECEDING))
SELECT conv_id, part, speaker, string_agg(head || said || chr(10), '' ORDER BY n) AS rendered,
  coalesce(string_agg(CAST(CAST(pos AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(pos + length(said) AS BIGINT) AS VARCHAR), ','
    ORDER BY n) FILTER (own), '') AS mask,
  count(*) AS n_messages, CAST(coalesce(sum(length(said)) FILTER (own), 0) AS BIGINT) AS n_masked_chars
FROM o GROUP BY conv_id, part, speaker""",
}
