"""Connected components of a table of links, by alternating large-star and small-star steps.

Every round is two grouped joins over the links; no node's neighbours are gathered in one task: a node's smallest
neighbour is a partial aggregate that is joined back. The table is written once per round and the rounds
grow with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskloom.llm.files import stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """``links`` (u, v) with u > v; every neighbour of a node moves to the smallest one it sees."""
    if large:
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = links
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = both.join(least, "u")
    if large:
        moved = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(joined.select("u", F.col("m").alias("v")))
    return moved.where("u > v").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node that has a link; the component is its smallest node.

    Null ends and loops are left out; repeated links and both directions count once; no link gives no row.
    """
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    now = links.select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).where(x.isNotNull() & y.isNotNull()).where("u > v").distinct()
    now = stored(now, "links")
    sign = F.struct(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s"))
    before = now.agg(sign.alias("x")).first()["x"]
    while before["n"]:
        now = stored(_star(_star(now, True), False), "links")
        after = now.agg(sign.alias("x")).first()["x"]
        if after == before:
            break
        before = after
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
