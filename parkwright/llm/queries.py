"""The registered queries of the operators, one each, over whole tables; and SQL for those it can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parkwright.llm import conversation_repair, filter_audit, language_id, licenses, mixing, packing, quality_fm, quality_rules, quotes, sharding, simhash_dedup, topk_search, warc
from parkwright.llm.oracles import ORACLE_SQL

TOKENIZER = "byte_bpe_50k"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str = TOKENIZER) -> tuple[str, str, dict[str, int]]:
    """The vocabulary file as ranks, its pattern, and the tokens its tokenizer file adds."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.tiktoken"), public_tokenizers.PATTERN, packing.added_tokens(public_tokenizers.path(f"{name}.json"))


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("id"), topk_search.whole_numbers(F.col("embedding")).alias("v"))
    return topk_search.search(rows, rows.where("id % 50 = 0"), k=5).select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(_table(spark, sf_dir, "documents"))


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(_table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.expr("cast(null as int)").alias("grown_shard"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = quality_fm.score(docs, quality_fm.train(docs, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", quality_fm.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= quality_fm.CUTOFF).cast("int").alias("predicted"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.reply_ordered(_table(spark, sf_dir, "conversations"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), *tokenizer())


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.learn(docs))
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = _table(spark, sf_dir, "conversations")
    return conversation_repair.repair(conversation_repair.damage(messages), messages)


_ALL = (
    op1_topk_search, op2_quality_rules, op3_simhash_dedup, op4_sharding, op5_quality_classifier, op6_mixing, op7_warc, op8_quotes, op9_licenses, op10_packing,
    op11_filter_audit, op12_language_id, op13_conversation_repair,
)
QUERIES = {f.__name__: f for f in _ALL}
__all__ = ["ORACLE_SQL", "QUERIES"]
