"""Registered queries of the operators: each reads its whole table and derives the digest columns from real outputs."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.llm import decontaminate, forest, jaccard, lines, merkle, mixing, quality, secrets, shards, spelling, sql, substrings, tokens, warc
from riskloom.session import scratch_path

TOKENIZER, VOCABULARY, END_ID = "word_bpe_49k.json", 49_408, 1


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op4_sharding(spark: SparkSession, sf: str) -> DataFrame:
    docs = shards.assign_shards(_table(spark, sf, "documents"), shards=8)
    return docs.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "split")


def op5_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = lines.drop_repeated_lines(_table(spark, sf, "documents").select("doc_id", "text"))
    return docs.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.sha2("_kept", 256).alias("kept_sha256"))


def op6_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = substrings.drop_repeated_substrings(_table(spark, sf, "documents").select("doc_id", "text"))
    return docs.select(
        "doc_id", F.col("_n_bytes").alias("n_bytes"), F.col("_n_removed").alias("n_removed"), F.col("_n_spans").alias("n_spans"), F.sha2("_kept", 256).alias("kept_sha256"))


def op7_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return quality.quality_rules(docs).select("doc_id", "_rules.*")


def op1_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.scan_secrets(_table(spark, sf, "documents"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != secrets.FOUND)
    return found.select(
        "doc_id", *[count(k) for k in secrets.KINDS], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), count(secrets.FOUND))


def op2_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contained_items(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def op3_token_files(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    return tokens.encode_and_read(_table(spark, sf, "documents").select("doc_id", "text"), public_tokenizers.path(TOKENIZER), END_ID, VOCABULARY)


def op8_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = mixing.mix_sources(_table(spark, sf, "documents"), keep=mixing.KEEP)
    return docs.select(
        "doc_id", "source", "lang", F.col("_topic").alias("topic"), F.col("_tokens").alias("n_tokens"), F.col("_weight").alias("cell_weight"),
        F.col("_chance").alias("chance"), F.col("_sampled").alias("sampled"), F.col("_clipped").alias("clipped"))


def op9_warc(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    captures = warc.write_archives(_table(spark, sf, "pages"), folder)
    return warc.read_captures(folder, warc.write_index(captures, folder))


def op10_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.jaccard_components(_table(spark, sf, "documents").select("doc_id", "text"))


def op11_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.variant_groups(_table(spark, sf, "documents").select("doc_id", "text"))


def op12_nearest_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return forest.nearest(_table(spark, sf, "embeddings").select("vec_id", "embedding"), every=50)


def op13_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, lowered).otherwise(F.col("text"))
    presented = [tampered if c == "text" else F.col(c) for c in merkle.FIELDS]
    found = merkle.prove(merkle.build(docs, claim=presented))
    return found.select(
        F.col("k").alias("doc_id"), "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", "verified")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secret_scan": op1_secret_scan,
        "op2_decontamination": op2_decontamination,
        "op3_token_files": op3_token_files,
        "op4_sharding": op4_sharding,
        "op5_line_dedup": op5_line_dedup,
        "op6_substring_dedup": op6_substring_dedup,
        "op7_quality_rules": op7_quality_rules,
        "op8_mixing": op8_mixing,
        "op9_warc": op9_warc,
        "op10_jaccard_join": op10_jaccard_join,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_nearest_neighbours": op12_nearest_neighbours,
        "op13_merkle_manifest": op13_merkle_manifest,
    }


def oracle_sql() -> dict[str, str]:
    return sql.ORACLES
