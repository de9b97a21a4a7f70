"""Queries of the operators with production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, html_text, langid, merkle, mixing, ngram_join, pii, secret_scan, sharding, sql, substring_dedup, token_align, vectors
from .common import table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

#: In production a secret from the cluster's configuration; here fixed, so that reruns agree.
PII_KEY = "surrogates-2024"


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(docs, VOCABULARY).drop("text")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), window=13)
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    dealt = sharding.histogram_sort(docs, "doc_id", "size", 16)
    return dealt.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).withColumn("n_chars", F.length("text").cast("long"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.top_k(table(spark, sf_dir, "embeddings"), every=100, k=10, scale=1024)


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_join(table(spark, sf_dir, "documents").select("doc_id", "text"), n=3, percent=90)


def op8_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.93)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs)
    found = langid.identify(docs.select("doc_id", "text", langid.held_out(F.col("doc_id")).alias("held_out")), model)
    return found.drop("text")


#: Columns of documents that make up a leaf, in order.
LEAF = ["doc_id", "source", "lang", "n_chars", "text"]


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*LEAF)
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    other = {"other": F.when(changed, merkle.leaves(docs, LEAF, lower=True))}
    found = merkle.manifest(docs, LEAF, carried=other)
    proof = F.sha2(F.array_join(F.transform("witness", lambda w: w["siblings"]), "").cast("binary"), 256)
    found = found.withColumn("folded_root", merkle.fold(F.coalesce("other", "leaf"), F.col("witness")))
    return found.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    aligned = token_align.alignments(table(spark, sf_dir, "documents").select("doc_id", "text"), a, b)
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    rows, _ = token_align.linked(aligned.withColumn("groups_sha256", digest), token_align.size(b))
    return rows


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owners are the sources; each document is a repository of its own."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = secret_scan.spans(*secret_scan.scan(docs))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


def queries() -> dict:
    return {f.__name__: f for f in (
        op1_bpe, op2_substring_dedup, op3_pii, op4_sharding, op5_html_text, op6_topk, op7_ngram_join, op8_near_vectors, op9_mixing, op10_langid, op11_merkle, op12_align, op13_secrets,
    )}


TOPK_SQL = """
WITH good AS (
  SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(1024 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, r.vec_id,
         CAST(list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * r.x[i])) AS BIGINT) AS score
  FROM good q JOIN good r ON r.vec_id <> q.vec_id AND len(q.x) = len(r.x)
  WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op6_topk": TOPK_SQL, "op11_merkle": sql.merkle(), "op13_secrets": sql.secrets()}
