"""The registered queries of the corpus operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import blockmax, crosspolytope, decontam, ecoc_langid, gbt_quality, k2treap, kdshard, merkle, packing, simhash, tokens, tokenstore, urlrules, warc
from .common import table


def op1_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_warc_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return warc.read(warc.write(pages, warc.new_folder(pages)))


def op3_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosspolytope.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdshard.shards(table(spark, sf_dir, "documents"))


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlrules.judge(table(spark, sf_dir, "pages"))


def op6_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), tokens.default_path()))


def op7_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return gbt_quality.score(docs, gbt_quality.train(docs, table(spark, sf_dir, "labels")))


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return tokenstore.read(tokenstore.write(docs, tokenstore.new_folder(docs), tokens.default_path()))


def op9_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return ecoc_langid.predict(docs, ecoc_langid.train(docs))


def op10_seed_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_merkle_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audited(merkle.build(table(spark, sf_dir, "documents"), claim=merkle.tampered()))


def op12_k2_treap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return k2treap.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_block_pruning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blockmax.top(table(spark, sf_dir, "embeddings"))


OP2_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS payload_digest FROM p),
w AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS chief FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND chief <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND chief <> page_id THEN chief END AS refers_to
FROM w
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_simhash_pivots, op2_warc_writer, op3_cross_polytope, op4_kd_shards, op5_url_rules, op6_vector_packing, op7_quality_trees, op8_token_store, op9_language_codes, op10_seed_align, op11_merkle_forward, op12_k2_treap, op13_block_pruning)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op2_warc_writer": OP2_SQL, "op5_url_rules": urlrules.ORACLE, "op11_merkle_forward": merkle.ORACLE, "op12_k2_treap": k2treap.ORACLE, "op13_block_pruning": blockmax.ORACLE}


