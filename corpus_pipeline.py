"""The corpus pipeline: stages that each apply one operator to all that the stage before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; :func:`run` writes each result as Parquet in the shared folder and
reads it again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import decontaminate, jaccard, mixing, quality, shards
from riskloom.llm.files import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.quality_rules(docs.select(*COLUMNS)).where("_rules.kept").drop("_rules")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by Jaccard similarity of five-word shingles the smallest id stays."""
    return jaccard.one_of_each(docs.select(*COLUMNS))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.without_contaminated(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that source, language and topic reach their target shares of tokens, a stated share of all tokens."""
    return mixing.mix_sources(docs.select(*COLUMNS), keep=mixing.KEEP).where("_sampled").select(*COLUMNS)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document: eight shards of equal bytes."""
    return shards.assign_shards(docs.select("doc_id", "text"), shards=8).select("doc_id", "size", "text_crc32", "shard", "slot")


STAGES = [
    ("quality_rules", quality_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("source_mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: Bin packing has no SQL form; the tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage for the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
