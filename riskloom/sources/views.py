"""Classification tables derived from the driver's star schema, whole tables each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

ITEM_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_cents"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loan-application-like rows: one per order, mixed types, missing cells, binary label.

    Customers grow with the orders, so they are shuffled, never collected on the driver to be broadcast.
    """
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer").hint("shuffle_hash")
    k = F.col("o_orderkey")
    label = ((F.col("o_totalprice") > 350000) & (F.col("c_acctbal") < 3000)) | ((k * 7919) % 100 < 3)
    return o.join(c, o.o_custkey == c.c_custkey).select(
        k.alias("ID"),
        "o_totalprice",
        F.when(k % 7 != 0, F.col("c_acctbal")).alias("c_acctbal"),
        F.when(k % 11 != 0, F.col("c_mktsegment")).alias("c_mktsegment"),
        "o_orderpriority",
        "o_orderstatus",
        label.cast("int").alias("label"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with two null-bearing numeric columns."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("l_cents"),
        "l_quantity",
        F.when(F.col("l_discount") != 0, F.col("l_discount")).alias("l_discount"),
        F.when(F.col("l_tax") != 0, F.col("l_tax")).alias("l_tax"),
        "l_returnflag", "l_linestatus",
    )


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents: a small imbalanced binary target."""
    d, lab = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return lab.join(d, "doc_id").select("doc_id", "lang", "source", "n_chars", "quality", "toxic")


def vecs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as v_1..v_64 with a ten-class label."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        "vec_id", *[F.col("embedding")[i].cast("double").alias(f"v_{i + 1}") for i in range(64)], "label"
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a deterministic score that has ties, and a binary label."""
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id",
        ((F.col("event_id") * 7919 % 1000) / 1000.0).alias("score"),
        (F.col("event_type") == "purchase").cast("int").alias("label"),
    )


APPS_SQL = """apps AS (
  SELECT o_orderkey AS "ID", o_totalprice,
         CASE WHEN o_orderkey % 7 <> 0 THEN c_acctbal END AS c_acctbal,
         CASE WHEN o_orderkey % 11 <> 0 THEN c_mktsegment END AS c_mktsegment,
         o_orderpriority, o_orderstatus,
         CAST((o_totalprice > 350000 AND c_acctbal < 3000) OR ((o_orderkey * 7919) % 100 < 3) AS INTEGER) AS label
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

ITEMS_SQL = """items AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS l_cents, l_quantity,
         CASE WHEN l_discount <> 0 THEN l_discount END AS l_discount,
         CASE WHEN l_tax <> 0 THEN l_tax END AS l_tax, l_returnflag, l_linestatus
  FROM lineitem)"""

DOCS_SQL = """docs AS (
  SELECT doc_id, lang, source, n_chars, quality, toxic FROM labels JOIN documents USING (doc_id))"""

VECS_SQL = """vecs AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings)"""

SCORED_SQL = """scored AS (
  SELECT event_id, (event_id * 7919 % 1000) / 1000.0::DOUBLE AS score,
         CAST(event_type = 'purchase' AS INTEGER) AS label FROM events)"""
