"""A stable unique row key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from riskloom.session import settle


def with_row_id(df: DataFrame, keys: Sequence[str] = (), out: str = "_rid") -> DataFrame:
    """Text key from the declared key columns, else content hash plus copy number.

    Several key columns are written as JSON, so neighbouring values cannot run together; NULL is no text. Declared keys that
    repeat identify no row; the content hash takes their place, so splits stay exact.
    Equal rows are interchangeable, so numbering copies gives the same result under any
    partitioning. Copies are numbered inside each input partition and offset by the
    counts of earlier partitions, so a large group of copies stays spread out.
    """
    if keys:
        text = [F.col(k).cast("string") for k in keys]
        one = F.coalesce(text[0], F.lit("\0"))
        several = F.to_json(F.struct(*[t.alias(f"k{i}") for i, t in enumerate(text)]), {"ignoreNullFields": "false"})
        named = df.withColumn(out, several if len(keys) > 1 else one)
        repeated = named.groupBy(out).agg(F.count("*").alias("n")).where("n > 1")
        if repeated.isEmpty():
            return named
        # Keys that do not identify a row: the content and the copy number do.
    content = F.md5(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}))
    base = settle(df.withColumn("_g", content).withColumn("_part", F.spark_partition_id()))
    counts = base.groupBy("_g", "_part").agg(F.count("*").alias("_c"))
    ahead = Window.partitionBy("_g").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_g", "_part", F.coalesce(F.sum("_c").over(ahead), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_g", "_part").orderBy(F.lit(0))
    numbered = base.join(offsets, ["_g", "_part"]).withColumn("_i", F.row_number().over(inside) + F.col("_off"))
    return numbered.withColumn(out, F.concat_ws("#", "_g", "_i")).select(*df.columns, out)
